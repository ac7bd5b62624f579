"""Byte-level BPE encoding and decoding in batched numpy merge rounds.

Words come from the tokenizer's own splitting pattern. The symbols of all new words of a batch lie in
one flat array; each round looks up the rank of every changed adjacent pair by binary search over the
sorted keys of all mergeable pairs, takes each word's lowest rank, and merges all places of it, left
to right. Words already seen by a worker are taken from a bounded table.

Defined cases: a null text is encoded like an empty one, to no ids; the strings of added tokens in a
text become those tokens, as the library does; ids out of range, and null ids, decode to nothing;
bytes that are not UTF-8 decode to U+FFFD; repeated rows, empty tables and any further columns pass
through (a column named like an output is replaced). Memory is bounded by the longest single text.
"""

from __future__ import annotations

import json
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isarithm.llm import words as W
from isarithm.llm.carry import with_kernel

#: Fixed value: the splitting pattern of byte-level tokenizer files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a worker remembers before it starts anew.
REMEMBERED = 300_000
NONE = np.iinfo(np.int32).max


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level files: printable Latin-1 is itself, the rest from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class _Seen(dict):
    """Numbers words in order of first sight."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Bpe:
    """A byte-level BPE of a tokenizers file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        kind = spec["model"].get("type", "BPE")
        if kind != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("a byte-level BPE file without normalizer is expected")
        vocab: dict[str, int] = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        spelled = [b""] * size
        for token, i in vocab.items():
            spelled[i] = bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            spelled[i] = token.encode()
        self.splitter = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.at = np.concatenate([[0], np.cumsum([len(b) for b in spelled])])
        self.of_byte = np.array([vocab[c] for c in alphabet], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.order = np.argsort(keys, kind="stable").astype(np.int32)
        self.keys = keys[self.order]
        self.words = regex.compile(PATTERN)
        self.forget()

    def forget(self) -> None:
        self.seen = _Seen()
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.fixed: dict[int, int] = {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)

    def merge(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[bounds[i]:bounds[i + 1]] in one array, and their bounds."""
        n = len(bounds) - 1
        sym = self.of_byte[data]
        word = np.repeat(np.arange(n), np.diff(bounds))
        rank = np.full(len(sym), NONE, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.ranks(sym[inner], sym[inner + 1])
        done_sym, done_word = [], []
        while len(sym):
            start = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(start, len(sym)))
            low = np.repeat(np.minimum.reduceat(rank, start), size)
            ended = low == NONE
            if ended.any():
                done_sym.append(sym[ended])
                done_word.append(word[ended])
                go = ~ended
                sym, word, rank, low = sym[go], word[go], rank[go], low[go]
                if not len(sym):
                    break
            hit = rank == low
            # Of places in a row (a pair of equal symbols) every second one merges.
            if (hit[1:] & hit[:-1]).any():
                place = np.arange(len(hit))
                opens = hit & ~np.concatenate([[False], hit[:-1]])
                hit &= (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
            p = np.flatnonzero(hit)
            sym[p] = self.result[rank[p]]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            q = p - np.arange(len(p))
            sym, word, rank = sym[keep], word[keep], rank[keep]
            for side in (q, q[q > 0] - 1):
                inside = side[side + 1 < len(sym)]
                rank[side] = NONE
                inside = inside[word[inside] == word[inside + 1]]
                rank[inside] = self.ranks(sym[inside], sym[inside + 1])
        if not done_sym:
            return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return sym[order].astype(np.int32), np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])

    def _split(self, text: str) -> list[str]:
        if self.splitter is None or self.splitter.search(text) is None:
            return self.words.findall(text)
        out: list[str] = []
        for part in self.splitter.split(text):
            if part in self.added:
                self.fixed.setdefault(self.seen["\0added " + part], self.added[part])
                out.append("\0added " + part)
            elif part:
                out += self.words.findall(part)
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and their bounds."""
        if len(self.seen) > REMEMBERED:
            self.forget()
        known = len(self.bounds) - 1
        per, numbers = [], []
        for text in texts:
            found = self._split(text) if text else []
            per.append(len(found))
            numbers.append(np.fromiter(map(self.seen.__getitem__, found), np.int64, len(found)))
        if len(self.seen) > known:
            new = list(islice(reversed(self.seen), len(self.seen) - known))[::-1]
            raw = [b"" if known + k in self.fixed else w.encode() for k, w in enumerate(new)]
            ids, bounds = self.merge(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
            for i, token in self.fixed.items():
                if i >= known:
                    ids, bounds = np.insert(ids, bounds[i - known], token).astype(np.int32), np.concatenate([bounds[: i - known + 1], bounds[i - known + 1 :] + 1])
            self.ids = np.concatenate([self.ids, ids])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + bounds[1:]])
        w = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        size = self.bounds[w + 1] - self.bounds[w]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = self.ids[np.repeat(self.bounds[w] - ends[:-1], size) + np.arange(ends[-1])]
        return out, ends[np.concatenate([[0], np.cumsum(per)])]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids[bounds[i]:bounds[i + 1]]."""
        ids = np.where((ids >= 0) & (ids < len(self.at) - 1), ids, len(self.at) - 1)
        at = np.append(self.at, self.at[-1])
        size = at[ids + 1] - at[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = self.bytes[np.repeat(at[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        cuts = ends[bounds]
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def _loaded(content: str) -> Bpe:
    return Bpe(content)


def _packed(ids: np.ndarray, bounds: np.ndarray) -> list[pa.Array]:
    """Number of ids of each text, and the ids as little-endian unsigned 32-bit integers."""
    return [pa.array(np.diff(bounds)), pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])]


def encode(docs: DataFrame, tokenizer: str, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """Adds n_tokens and ids, the text's ids as little-endian unsigned 32-bit integers.

    `tokenizer` is the path of a tokenizers file that the driver can read; its content goes to the workers.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def kernel(given: list[pa.Array]) -> list[pa.Array]:
        return _packed(*_loaded(shared.value).encode(given[0].to_pylist()))

    keep = [c for c in docs.columns if keep_text or c != text_col]
    return with_kernel(docs, [F.col(f"`{text_col}`").cast("string")], kernel, [("n_tokens", T.LongType()), ("ids", T.BinaryType())], keep, lambda batch: W.pieces(batch, 0, 1 << 20))


def decode(rows: DataFrame, tokenizer: str, ids_col: str = "ids", out_col: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """Adds the text that the packed ids stand for; special tokens are spelled out."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = rows.sparkSession.sparkContext.broadcast(file.read())

    def kernel(given: list[pa.Array]) -> list[pa.Array]:
        data, at = W.flat(given[0])
        return [pa.array(_loaded(shared.value).decode(np.frombuffer(data.tobytes(), "<u4").astype(np.int64), at // 4), pa.string())]

    keep = [c for c in rows.columns if keep_ids or c != ids_col]
    return with_kernel(rows, [F.col(f"`{ids_col}`")], kernel, [(out_col, T.StringType())], keep, lambda batch: W.pieces(batch, 0, 1 << 20))


def encode_and_decode(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """Adds n_tokens and ids as encode does, and puts the text that the ids stand for in the text's place.

    One kernel does both: encode and decode one after the other keep two Python workers a task.
    """
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def kernel(given: list[pa.Array]) -> list[pa.Array]:
        bpe = _loaded(shared.value)
        ids, bounds = bpe.encode(given[0].to_pylist())
        return [pa.array(bpe.decode(ids.astype(np.int64), bounds), pa.string()), *_packed(ids, bounds)]

    new = [(text_col, T.StringType()), ("n_tokens", T.LongType()), ("ids", T.BinaryType())]
    out = with_kernel(docs, [F.col(f"`{text_col}`").cast("string")], kernel, new, docs.columns, lambda batch: W.pieces(batch, 0, 1 << 20))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("n_tokens", "ids")], "n_tokens", "ids")
