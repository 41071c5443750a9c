"""Best-two-fit packing of tokenized documents into sequences of a fixed capacity.

Tokenizing is one pass over the texts; only (id, piece, start, length, checksum) goes through the shuffle. Pieces are
dealt to groups by a hash of their contents and packed group by group, so that a group is bounded whatever the table.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c

CAPACITY = 2048
#: Pieces that are packed together; larger groups waste less and take more memory (some 60 bytes a piece).
GROUP = 4096
#: Words whose ids a Python worker remembers, at most (some 40 bytes each); beyond it starts anew.
REMEMBERED = 500_000
#: Texts are tokenized in blocks of about so many bytes; a worker holds some 130 bytes for each of them.
BLOCK = 1 << 18
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Characters below this are split here; a text with any other goes to the tokenizer as it is.
PLAIN = 0x250


def _classes() -> np.ndarray:
    """0 white space, 1 letter, 2 number (each by itself), 3 other, of the characters below PLAIN."""
    import regex

    out = np.full(PLAIN, 3, np.uint8)
    for k in range(PLAIN):
        for value, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
            if regex.match(pattern, chr(k)):
                out[k] = value
    return out


class Words:
    """The ids of whole texts by tokenizers, with the ids of a word computed once.

    The vocabulary file normalizes (NFC, white space, lower case) and splits into runs of letters, single numbers and
    runs of other characters, which are encoded one by one. Here a block of texts is split so with NumPy, and only its
    distinct words go to the tokenizer. Texts with an apostrophe (the file splits English contractions by it), with
    characters from PLAIN on or with the literal of an added token (<|endoftext|>) go to the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        import re

        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        # For words that are already normalized and split: white space is all that parts them. Both share one model.
        self.single = Tokenizer(self.tokenizer.model)
        self.single.normalizer = normalizers.Sequence([])
        self.single.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=False)])
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # In any case, since _plain() may hand lower-case texts to the tokenizer.
        self.other = re.compile("|".join(["['\u0130" + chr(PLAIN) + "-\U0010ffff]", *[f"(?i:{x})" for x in added]])).search
        self.classes = _classes()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.begin, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Remember the ids of new words, whose hashes are keys (sorted)."""
        parts = self.single.encode_batch_fast([" ".join(words[i : i + 500]) for i in range(0, len(words), 500)], add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, np.uint32) for e in parts])
        stop = np.flatnonzero(self.ends[ids]) + 1
        if len(stop) != len(words):  # a vocabulary that does not mark the end of each word
            each = self._ids(words)
            ids, stop = np.frombuffer(b"".join(each), "<u4"), np.cumsum([len(e) // 4 for e in each])
        begin = np.concatenate([[0], stop[:-1]])
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.begin = np.insert(self.begin, at, begin + len(self.flat))
        self.size = np.insert(self.size, at, stop - begin)
        self.flat = np.concatenate([self.flat, ids])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        hard = [self.other(t) is not None for t in texts]
        plain = iter(self._plain([unicodedata.normalize("NFC", t).lower() for t, x in zip(texts, hard, strict=True) if not x]))
        whole = iter(self._ids([t for t, x in zip(texts, hard, strict=True) if x]))
        return [next(whole if x else plain) for x in hard]

    def _plain(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        joined = "\n".join(texts) + "\n"
        x = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if x.max() >= PLAIN:  # a lower-case form of several characters
            return self._ids(texts)
        kind = self.classes[x]
        edge = np.concatenate([[True], (kind[1:] != kind[:-1]) | (kind[1:] == 2)])
        at = np.flatnonzero(edge)
        stop = np.append(at[1:], len(x))
        solid = kind[at] > 0
        at, stop = at[solid], stop[solid]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        h, first, which = np.unique(c.span_hash(x, at, stop, least=BLOCK), return_index=True, return_inverse=True)
        for _ in range(2):
            at0 = np.searchsorted(self.keys, h)
            known = self.keys[np.minimum(at0, len(self.keys) - 1)] == h if len(self.keys) else np.zeros(len(h), bool)
            if known.all():
                break
            if len(self.keys) + (~known).sum() > REMEMBERED:
                self._forget()
                known[:] = False
            new = np.flatnonzero(~known)
            a, b = at[first[new]].tolist(), stop[first[new]].tolist()
            self._learn(h[new], [joined[i:j] for i, j in zip(a, b, strict=True)])
        flat, size, begin = self.flat, self.size[at0], self.begin[at0]
        size, begin = size[which], begin[which]
        total = np.cumsum(size)
        ids = flat[np.arange(total[-1]) + np.repeat(begin - (total - size), size)] if len(total) else flat
        cut = np.concatenate([[0], total])[np.concatenate([[0], np.searchsorted(at, ends)])].tolist()
        return [ids[i:j].tobytes() for i, j in zip(cut, cut[1:], strict=False)]


_loaded: dict[str, Words] = {}


def words(path: str) -> Words:
    # A task has one core, and each thread of the tokenizer would keep a heap of its own.
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _loaded:
        _loaded[path] = Words(path)
    return _loaded[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document: its ids, then end_id, cut into pieces of capacity.

    A null or empty text is end_id alone. Rows are kept as they are, repeated ids too; other columns are ignored.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    @c.task
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = words(tokenizer).encode
        for b in c.blocks(batches, limit=BLOCK):
            rows = []
            for doc, ids in zip(b.column(0).to_pylist(), encode([t or "" for t in b.column(1).to_pylist()]), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    x = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(x) // 4, zlib.crc32(x)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of each length (1 to capacity). Ties go to the earlier item.

    A bin takes the longest item that fits, again and again. Then its smallest item gives way to the two unpacked items
    of the largest sum that the gap it leaves can hold, if that sum is more than the item.
    """
    count = np.bincount(lengths, minlength=capacity + 1).tolist()
    have = sum(1 << n for n, k in enumerate(count) if k)
    bins: list[list[int]] = []

    def longest(most: int) -> int:
        return (have & ((2 << most) - 1)).bit_length() - 1 if most > 0 else -1

    def take(n: int) -> None:
        nonlocal have
        count[n] -= 1
        if not count[n]:
            have ^= 1 << n

    def give(n: int) -> None:
        nonlocal have
        count[n] += 1
        have |= 1 << n

    while have:
        own, room = [], capacity
        while (n := longest(room)) > 0:
            take(n)
            own.append(n)
            room -= n
        if room and have:
            least = own[-1]
            gap, best, pair = room + least, least, None
            a = longest(gap - 1)
            while a > 0 and 2 * a > best:
                b = longest(min(a if count[a] > 1 else a - 1, gap - a))
                if b > 0 and a + b > best:
                    best, pair = a + b, (a, b)
                    if best == gap:
                        break
                a = longest(a - 1)
            if pair:
                give(least)
                own[-1:] = pair
                take(pair[0])
                take(pair[1])
        bins.append(own)
    order = np.argsort(lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(lengths, minlength=capacity + 1))])[: capacity + 1].tolist()
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for k, own in enumerate(bins):
        at = 0
        for n in own:
            i = order[first[n]]
            first[n] += 1
            where[i], offset[i] = k, at
            at += n
    return where, offset


def pack(parts: DataFrame, rows: int, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """parts (see pieces()) with sequence_id and offset. rows: about how many parts there are.

    Groups are dealt by a hash of the row, so a lost task is repeated alike; equal rows get different places.
    """
    n = max(1, -(-rows // group))

    def one(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
        where, offset = best_two_fit(g["length"].to_numpy(), capacity)
        g["sequence_id"] = where + (g.pop("__group").iloc[0].astype(np.int64) << 32)
        g["offset"] = offset
        return g

    dealt = parts.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(n)))
    return dealt.groupBy("__group").applyInPandas(one, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """All documents as pieces with a place in a sequence. An empty table gives no rows."""
    return pack(pieces(docs, tokenizer, capacity), max(docs.count(), c.plan_bytes(docs) // 4096), capacity, group)


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(c.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
