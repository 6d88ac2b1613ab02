"""BPE encoding and decoding with contiguous rank arrays.

A word is a row of part ids and a row of the ranks of adjacent parts. The smallest rank is found by
a scan, its boundary is deleted, and the ranks of the two neighbours are looked up anew, until no
adjacent pair has a rank. Many short words are worked on at once, one matrix row each; words of
over `LONG` symbols, for which repeated scans would take quadratic time, use a heap instead.

Results equal those of the tokenizers library for the two kinds of files it is used with here: byte
level BPE, and BPE over lower-cased words with a word-end suffix. Files are read from a path that is
a parameter; on a cluster the path must exist on every executor.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Symbols of a word that is worked on by scans.
LONG = 48
#: Pieces of text that a worker remembers; twice as many at most.
REMEMBERED = 400_000
#: Code points that are cut into pieces at once.
SLICE = 1_000_000
NONE = np.int32(2**31 - 1)

# Fixed values of the byte-level format: white space (Unicode White_Space) and the word pattern.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next free one from U+0100."""
    own = {b for a, z in (("!", "~"), ("¡", "¬"), ("®", "ÿ")) for b in range(ord(a), ord(z) + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _unicode_space(pattern: str) -> str:
    r"""The pattern with \s and \S as the Unicode White_Space class, which differs from the module's own."""
    return pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\s", f"[{SPACE}]").replace(r"\S", f"[^{SPACE}]")


class Bpe:
    """Encoder of one tokenizer file. `encode` gives, for each text, its ids as little-endian unsigned
    32-bit integers."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.by_word = spec.get("normalizer") is not None
        if self.by_word:
            pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        else:
            pattern = BYTE_LEVEL_WORDS
        self.pattern = regex.compile(_unicode_space(pattern))
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        symbols = byte_symbols()
        self.first = np.array([vocab[c] for c in symbols], np.int32)
        self.last = np.array([vocab[c + self.suffix] for c in symbols], np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int32)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self._hash(keys[order], order.astype(np.int32))
        self.texts = {i: t.encode() for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        if not self.by_word:
            back = {ord(c): b for b, c in enumerate(symbols)}
            self.texts = {i: bytes(back[ord(c)] for c in t) if all(ord(c) in back for c in t) else t.encode() for t, i in vocab.items()} | {i: t.encode() for t, i in self.added.items()}
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    # words ---------------------------------------------------------------------------------------

    def _hash(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """An open-addressing table of the pairs that have a rank, a quarter full."""
        size = 1 << max(4, (4 * len(keys)).bit_length())
        self.mask, self.slots, self.rank_at = size - 1, np.full(size, -1, np.int64), np.full(size, NONE, np.int32)
        at = _mixed(keys) & self.mask
        while len(keys):
            free = np.flatnonzero(self.slots[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            won = free[one]
            self.slots[at[won]], self.rank_at[at[won]] = keys[won], ranks[won]
            rest = np.ones(len(keys), bool)
            rest[won] = False
            keys, ranks, at = keys[rest], ranks[rest], (at[rest] + 1) & self.mask

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a.astype(np.int64) << 32 | b).ravel()
        at = _mixed(key) & self.mask
        seen = self.slots[at]
        out = np.where(seen == key, self.rank_at[at], NONE)
        left = np.flatnonzero((seen != key) & (seen >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            seen = self.slots[at[left]]
            hit = seen == key[left]
            out[left[hit]] = self.rank_at[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out.reshape(a.shape)

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word (not empty)."""
        out: list[bytes] = [b""] * len(words)
        lengths = np.array([len(w) for w in words], np.int64)
        order = np.argsort(lengths, kind="stable")
        short = order[lengths[order] <= LONG]
        for i in range(0, len(short), 4096):
            self._scan(words, short[i : i + 4096], out)
        for i in order[len(short) :]:
            out[i] = self._heap(words[i])
        return out

    def _scan(self, words: list[bytes], own: np.ndarray, out: list[bytes]) -> None:
        chosen = [words[i] for i in own]
        n, width = len(chosen), max(map(len, chosen))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in chosen), np.uint8).reshape(n, width)
        size = np.array([len(w) for w in chosen])
        row = np.arange(n)
        parts = self.first[raw]
        parts[row, size - 1] = self.last[raw[row, size - 1]]
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        ranks[np.arange(1, width)[None, :] >= size[:, None]] = NONE
        while True:
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)
                least = ranks[row, at]
                more = least < NONE
            else:
                more = np.zeros(len(own), bool)
            if not more.all():
                ended = np.flatnonzero(~more)
                flat, step = parts[ended].astype("<u4").tobytes(), 4 * parts.shape[1]
                for k, (i, n) in enumerate(zip(own[ended].tolist(), size[ended].tolist(), strict=True)):
                    out[i] = flat[k * step : k * step + 4 * n]
                if not more.any():
                    return
                own, parts, ranks, size, at, least = own[more], parts[more], ranks[more], size[more], at[more], least[more]
                row = np.arange(len(own))
            parts[row, at] = self.merged[least]
            column = np.arange(parts.shape[1] - 1)[None, :]
            parts = np.take_along_axis(parts, column + (column > at[:, None]), 1)
            column = column[:, :-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), 1)
            size = size - 1
            i = np.flatnonzero(at > 0)
            ranks[i, at[i] - 1] = self._ranks(parts[i, at[i] - 1], parts[i, at[i]])
            i = np.flatnonzero(at + 1 < size)
            ranks[i, at[i]] = self._ranks(parts[i, at[i]], parts[i, at[i] + 1])

    def _heap(self, word: bytes) -> bytes:
        raw = np.frombuffer(word, np.uint8)
        ids = self.first[raw]
        ids[-1] = self.last[raw[-1]]
        first = self._ranks(ids[:-1], ids[1:])
        parts, after, before = ids.tolist(), [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(int(first[i]), int(i), parts[i], parts[i + 1]) for i in np.flatnonzero(first < NONE)]
        heapq.heapify(heap)
        rank = {}

        def push(i: int, j: int) -> None:
            pair = parts[i], parts[j]
            if pair not in rank:
                rank[pair] = int(self._ranks(np.array([pair[0]], np.int32), np.array([pair[1]], np.int32))[0])
            if rank[pair] < NONE:
                heapq.heappush(heap, (rank[pair], i, *pair))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.merged[r]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([x for x in parts if x >= 0], "<u4").tobytes()

    # texts ---------------------------------------------------------------------------------------

    def _pieces(self, text: str) -> Iterator[list[str]]:
        """The text as lists of keys of pieces that are encoded on their own.

        Word kind: what white space parts. Byte level: text before a single space that a word
        follows, with that space; the space is left out of the key, and a piece without one gets
        a space as its first character, which no other key has.
        """
        if self.by_word:
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > SLICE and (m := _between.search(text, at + SLICE)):
                end = m.start() + 1
            part = text[at:end] if at or end < len(text) else text
            at = end
            if self.by_word:
                yield part.split() if not _OTHERS.intersection(part) else [x for x in _white.split(part) if x]
                continue
            if part[0] == " " and part[1:2] and not _white.match(part[1:2]):
                part, lead = part[1:], ""
            else:
                lead = " "
            if part[-1:] == " " or any(" " + c in part for c in (_WHITE_ASCII if part.isascii() else _WHITE)):
                keys = _parting.split(part)
            else:
                keys = part.split(" ")
            keys[0] = lead + keys[0]
            yield keys

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        plan: list[list] = []
        unknown: set[str] = set()
        get = self.new.get
        for text in texts:
            parts: list = []
            segments = self.split_added.split(text) if self.split_added and any(x in text for x in self.added) else [text]
            for segment in segments:
                if segment in self.added:
                    parts.append(np.array([self.added[segment]], "<u4").tobytes())
                elif segment:
                    for keys in self._pieces(segment):
                        found = [*map(get, keys)]
                        if None in found:
                            unknown.update([k for k, x in zip(keys, found, strict=True) if x is None])
                            parts.append((keys, found))
                        else:
                            parts.append(b"".join(found))
            plan.append(parts)
        self._learn(unknown)
        get = self.new.get
        return [b"".join([part if isinstance(part, bytes) else b"".join([get(k) if x is None else x for k, x in zip(*part, strict=True)]) for part in parts]) for parts in plan]

    def _learn(self, keys: set[str]) -> None:
        """See that all keys are among the new pieces."""
        if len(self.new) + len(keys) > REMEMBERED:
            self.old, self.new = self.new, {}
        missing = keys.difference(self.new)
        if again := missing.intersection(self.old):
            self.new |= {k: self.old[k] for k in again}
            missing -= again
        if not missing:
            return
        order = list(missing)
        find = self.pattern.findall
        texts = order if self.by_word else [k[1:] if k[:1] == " " else " " + k for k in order]
        cut = [[w.encode("utf-8", "surrogatepass") for w in find(t)] for t in texts]
        unique = list({w for ws in cut for w in ws})
        ids = dict(zip(unique, self.words(unique), strict=True))
        for k, ws in zip(order, cut, strict=True):
            self.new[k] = ids[ws[0]] if len(ws) == 1 else b"".join([ids[w] for w in ws])

    def decode(self, ids: np.ndarray) -> str:
        """As the library decodes, special tokens included: parts joined by spaces where the file has no
        decoder (word kind), else the bytes that they stand for."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return (b" " if self.by_word else b"").join(map(self.texts.__getitem__, ids.tolist()))


_WHITE = [chr(c) for a, z in ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for c in range(a, z + 1)]
_WHITE_ASCII = _WHITE[:6]
#: Python counts these as white space, Unicode's White_Space doesn't.
_OTHERS = {"\x1c", "\x1d", "\x1e", "\x1f"}
_white = re.compile(f"[{SPACE}]")
#: A single space between two words.
_between = re.compile(f"[^{SPACE}] [^{SPACE}]")
_parting = re.compile(f" (?=[^{SPACE}])")
_loaded: dict[str, Bpe] = {}


def _mixed(key: np.ndarray) -> np.ndarray:
    return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64)


def loaded(path: str) -> Bpe:
    """One encoder per file and worker process."""
    if path not in _loaded:
        _loaded[path] = Bpe(path)
    return _loaded[path]


def texts_in_groups(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with about `most` code points each, and their texts (null: empty)."""
    for batch in batches:
        start, size, texts = 0, 0, []
        for i, text in enumerate(batch.column(column)):
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= most or i + 1 == batch.num_rows:
                yield batch.slice(start, i + 1 - start), texts
                start, size, texts = i + 1, 0, []


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `df`: doc_id, n_tokens, ids_sha256, decoded_sha256, over whole texts.

    A null text counts as empty (no ids, the digest of nothing); a null id stays null; repeated
    rows are encoded each. Very long texts and words take time in proportion to their length times
    its logarithm. No rows give no rows. Other columns of `df` are not read.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch, texts in texts_in_groups(batches):
            n, a, b = [], [], []
            for raw in bpe.encode(texts):
                ids = np.frombuffer(raw, "<u4")
                n.append(len(ids))
                a.append(hashlib.sha256(raw).hexdigest())
                text = bpe.decode_bytes(ids)
                if not bpe.by_word:
                    text = text.decode("utf-8", "replace").encode()
                b.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text").mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
