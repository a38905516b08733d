"""Byte-level BPE encoding and decoding in flat numpy arrays.

The bytes of many texts stand in one array. The pre-tokeniser's words are found from the
kinds of neighbouring characters; words met before are looked up in a hash table
that holds their bytes and ids, the others are encoded side by side: in every
round the ranks of all neighbouring pairs are looked up, and each word merges its
lowest-ranked pair wherever it occurs.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import mix, small_batches, tidy

CACHE_CHUNKS = 500_000   # words remembered per Python worker; beyond them those go that came but once
MERGE_WORDS = 100_000    # new words merged side by side
EIGHTS = 4               # words of up to so many times 8 bytes are remembered

# Kinds of characters of the pre-tokeniser's pattern, which is
# 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
_OTHER, _LETTER, _NUMBER, _WHITE, _UNKNOWN = range(5)
_KINDS = regex.compile(r"(\p{L})|(\p{N})|(\s)")
_MASK = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)     # the first k of 8 bytes


def _byte_letters() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable bytes stand for themselves, the others for U+0100 onwards."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _kind(c: str) -> int:
    m = _KINDS.match(c)
    return m.lastindex if m else _OTHER


class Table:
    """Where each of many distinct 64-bit keys stands: open addressing in one array."""

    def __init__(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.table = np.full(16, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        bits = len(self.table).bit_length() - 1
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one that is not there."""
        slot = self._slots(keys)
        out = self.table[slot]
        if not len(self.keys):
            return out
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(open_):                            # another key stands there: look behind it
            slot[open_] = (slot[open_] + 1) & (len(self.table) - 1)
            found = out[open_] = self.table[slot[open_]]
            open_ = open_[(found >= 0) & (self.keys[found] != keys[open_])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Place distinct keys that are not there behind those that are."""
        first = len(self.keys)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.table):
            self.table = np.full(1 << (3 * len(self.keys)).bit_length(), -1, np.int32)
            first = 0
        place = np.arange(first, len(self.keys), dtype=np.int32)
        slot = self._slots(self.keys[first:])
        while len(place):
            free = self.table[slot] < 0
            self.table[slot[free]] = place[free]
            left = self.table[slot] != place         # of several that met in one slot, one stays
            place, slot = place[left], (slot[left] + 1) & (len(self.table) - 1)


class Memory:
    """Words of at most 8 * EIGHTS bytes and their ids."""

    def __init__(self, dtype: type) -> None:
        self.table = Table()
        self.size = np.zeros(0, np.uint8)                       # bytes of each word
        self.parts = np.zeros((EIGHTS, 0), np.uint64)           # its bytes, eight by eight
        self.ids = np.zeros(0, dtype)                           # ids of all words
        self.at, self.count = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.again = np.zeros(0, bool)                          # came again after it was learned

    def _same(self, place: np.ndarray, size: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Which words are those at ``place``, byte for byte."""
        ok = self.size[place] == size
        for k, (rows, part) in enumerate(parts):
            ok[rows] &= self.parts[k, place[rows]] == part
        return ok

    def find(self, key: np.ndarray, size: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word (-1: not there), and which words share a key with another word."""
        place = self.table.find(key)
        if not len(self.size):
            return place, np.zeros(len(place), bool)
        clash = (place >= 0) & ~self._same(place, size, parts)
        place[clash] = -1
        return place, clash

    def add(self, key: np.ndarray, size: np.ndarray, parts: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        self.table.add(key)
        self.at = np.concatenate([self.at, (len(self.ids) + np.cumsum(count) - count).astype(np.int32)])
        self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count.astype(np.uint8)])
        self.size, self.parts = np.concatenate([self.size, size.astype(np.uint8)]), np.concatenate([self.parts, parts], axis=1)
        self.again = np.concatenate([self.again, np.zeros(len(key), bool)])

    def kept(self) -> Memory:
        """A memory of the words that came again; an empty one if they are too many too."""
        out, keep = Memory(self.ids.dtype), np.flatnonzero(self.again)
        if 2 * len(keep) <= CACHE_CHUNKS:
            count = self.count[keep].astype(np.int64)
            out.add(self.table.keys[keep], self.size[keep], self.parts[:, keep], spans(self.ids, self.at[keep], count), count)
        return out


def spans(values: np.ndarray, at: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``values[at[i]:at[i] + count[i]]`` of all i, one behind the other."""
    ends = np.cumsum(count)
    return values[np.repeat(at - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)]


class Codec:
    """Encoder and decoder for one byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        vocab = spec["model"]["vocab"]
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (1 + max([*vocab.values(), *self.added.values()]))
        for token, i in vocab.items():
            if token not in self.added:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        self.dtype = np.uint16 if len(self.bytes_of) <= 1 << 16 else np.uint32
        self.width = np.dtype(self.dtype).itemsize
        self.byte_id = np.zeros(256, dtype=np.int64)
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, made = (np.array(x, dtype=np.uint64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs))) if pairs else (
            np.zeros(0, np.uint64),) * 3
        self.made = made.astype(np.uint32)           # by rank
        self.pairs = Table()
        self.pairs.add((left << np.uint64(32)) | right)
        self.byte_id = self.byte_id.astype(np.uint32)
        # Ranks of the pairs of bytes, or none.
        self.none = np.int32(len(pairs))
        both = (np.repeat(self.byte_id, 256).astype(np.uint64) << np.uint64(32)) | np.tile(self.byte_id, 256)
        self.byte_rank = self._ranks(both)
        self.kinds = np.full(0x110000, _UNKNOWN, np.uint8)      # of code points; found when first met
        self.kinds[:128] = [_kind(chr(c)) for c in range(128)]
        self.special = re.compile(b"|".join(re.escape(a.encode()) for a in sorted(self.added, key=len, reverse=True))) if self.added else None
        self.memory = Memory(self.dtype)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        found = self.pairs.find(pairs)
        found[found < 0] = self.none
        return found

    def merge(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words that stand one behind the other in ``raw``, and how many each has (none is empty)."""
        word = np.repeat(np.arange(len(size), dtype=np.int32), size)
        sym = self.byte_id[raw]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        none = self.none
        # pair[i]: the rank of the symbols i and i + 1 of one word, or none.
        pair = np.full(len(sym), none)
        pair[:-1] = np.where(word[1:] == word[:-1], self.byte_rank[raw[:-1].astype(np.int32) * 256 + raw[1:]], none)
        count = size
        while len(sym):
            heads = np.cumsum(count) - count
            best = np.minimum.reduceat(pair, heads)
            live = best < none
            if not live.all():                       # words without a pair are finished
                keep = np.repeat(live, count)
                done.append((sym[~keep], word[~keep]))
                sym, word, pair = sym[keep], word[keep], pair[keep]
                best, count = best[live], count[live]
                if not len(sym):
                    break
            hit = pair == np.repeat(best, count)
            # Equal neighbours (aaa) make overlapping hits: from the left, every second one of a run counts.
            if np.any(hit[1:] & hit[:-1]):
                i = np.arange(len(hit))
                last_miss = np.maximum.accumulate(np.where(hit, -1, i))
                hit &= (i - last_miss) % 2 == 1
            where = np.flatnonzero(hit)
            sym[where] = self.made[pair[where]]
            rest = np.ones(len(sym), dtype=bool)
            rest[where + 1] = False
            count = np.add.reduceat(rest, np.cumsum(count) - count, dtype=np.int64)
            sym, word, pair = sym[rest], word[rest], pair[rest]
            # Only pairs with a new symbol need a search in the next round.
            new = where - np.arange(len(where))
            pair[new] = none
            touched = np.concatenate([new[new + 1 < len(sym)], new[new > 0] - 1])
            pair[touched] = none
            touched = touched[word[touched] == word[touched + 1]]
            pair[touched] = self._ranks((sym[touched].astype(np.uint64) << np.uint64(32)) | sym[touched + 1])
        done.append((sym, word))
        sym, word = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        order = np.argsort(word, kind="stable")
        return sym[order].astype(self.dtype), np.bincount(word, minlength=len(size))

    def _merged(self, buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        made = [self.merge(spans(buf, at[i:i + MERGE_WORDS], size[i:i + MERGE_WORDS]), size[i:i + MERGE_WORDS])
                for i in range(0, len(at), MERGE_WORDS)]
        return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])

    def _byte_kinds(self, buf: np.ndarray, n: int) -> np.ndarray:
        """The kind of the character that each of the first ``n`` bytes belongs to (at least 3 zeros follow them)."""
        kind = self.kinds[buf[:n]]
        lead = np.flatnonzero(buf[:n] >= 0xC0)
        if len(lead):
            b0, b1, b2, b3 = (buf[lead + k].astype(np.int32) for k in range(4))
            width = 2 + (b0 >= 0xE0) + (b0 >= 0xF0)
            b1, b2, b3 = b1 & 63, b2 & 63, b3 & 63
            point = np.where(width == 2, (b0 & 31) << 6 | b1, np.where(
                width == 3, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
            found = self.kinds[point]
            if np.any(found == _UNKNOWN):
                fresh = np.unique(point[found == _UNKNOWN])
                self.kinds[fresh] = [_kind(chr(c)) for c in fresh.tolist()]
                found = self.kinds[point]
            for k in range(4):
                here = width > k
                kind[lead[here] + k] = found[here]
        return kind

    def _words(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the words of the texts ``buf[offsets[i]:offsets[i+1]]`` begin (at least 3 zeros follow the last text)."""
        n = int(offsets[-1])
        kind = self._byte_kinds(buf, n)
        edge = np.zeros(n + 4, bool)                 # a text begins here, or all end
        edge[offsets] = True
        start = np.zeros(n + 4, bool)
        start[1:n] = kind[1:] != kind[:-1]
        start |= edge
        run = np.flatnonzero(start[:n + 1])
        white = np.flatnonzero(kind[run[:-1]] == _WHITE)
        end = run[white + 1]
        end = end[~edge[end]]                        # white space at a text's end is one word
        last = end - 1                               # else its last character stands alone,
        back = (buf[last] & 0xC0) == 0x80
        while back.any():
            last[back] -= 1
            back = (buf[last] & 0xC0) == 0x80
        start[last] = True
        start[end[buf[last] == 32]] = False          # and a space goes with what follows
        quote = np.flatnonzero((buf[:n] == 39) & start[:n])
        quote = quote[~edge[quote + 1]]
        one, two = buf[quote + 1], buf[quote + 2]
        short = (one == ord("s")) | (one == ord("t")) | (one == ord("m")) | (one == ord("d"))
        long = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & ~edge[quote + 2]
        for found, size in ((quote[short], 2), (quote[long], 3)):
            start[found + 1] = False
            start[found + size] = True
        return np.flatnonzero(start[:n])

    def _specials(self, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
        """(first byte, last byte + 1, id) of the special tokens in the texts."""
        if self.special is None or not self.special.search(buf[:offsets[-1]].tobytes()):
            return []
        return [(a + m.start(), a + m.end(), self.added[m.group().decode()]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                for m in self.special.finditer(buf[a:b].tobytes())]

    def encode_flat(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts ``buf[offsets[i]:offsets[i+1]]`` (UTF-8; offsets from 0), and bounds:
        text i owns ``ids[bounds[i]:bounds[i+1]]``."""
        n = int(offsets[-1])
        if not n:
            return np.zeros(0, self.dtype), np.zeros(len(offsets), np.int64)
        buf = np.concatenate([buf[:n], np.zeros(8 * EIGHTS, np.uint8)])
        special = self._specials(buf, offsets)
        if special:
            first, end, which = (np.array(x, np.int64) for x in zip(*special))
            cut = np.unique(np.concatenate([offsets, first, end]))
            word = self._words(buf, cut)
            owner = np.searchsorted(first, word, side="right") - 1
            word = word[(owner < 0) | (word >= end[owner]) | (word == first[owner])]
            is_special = np.searchsorted(word, first)
        else:
            word = self._words(buf, offsets)
        size = np.diff(np.append(word, n))
        if len(self.memory.size) > CACHE_CHUNKS:
            self.memory = self.memory.kept()
        memory = self.memory
        brief = size <= 8 * EIGHTS
        if special:
            brief[is_special] = False
        at, count = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        rows = np.flatnonzero(brief)
        key, parts = self._keys(buf, word[rows], size[rows])
        place, clash = memory.find(key, size[rows], parts)
        memory.again[place[place >= 0]] = True
        fresh = np.flatnonzero((place < 0) & ~clash)
        if len(fresh):
            fresh = fresh[np.unique(key[fresh], return_index=True)[1]]
            few = rows[fresh]
            ids, counts = self._merged(buf, word[few], size[few])
            whole = np.zeros((EIGHTS, len(fresh)), np.uint64)
            for k, part in enumerate(self._parts(buf, word[few], size[few])):
                whole[k, part[0]] = part[1]
            memory.add(key[fresh], size[few], whole, ids, counts)
            place, clash = memory.find(key, size[rows], parts)
        held = place >= 0
        at[rows[held]], count[rows[held]] = memory.at[place[held]], memory.count[place[held]]
        source = memory.ids
        # Long words, and those whose key is another word's, are not remembered.
        rest = np.concatenate([np.flatnonzero(~brief), rows[~held]])
        if special:
            rest = np.setdiff1d(rest, is_special)
            at[is_special], count[is_special] = len(source) + np.arange(len(special)), 1
            source = np.concatenate([source, which.astype(self.dtype)])
        if len(rest):
            ids, counts = self._merged(buf, word[rest], size[rest])
            at[rest], count[rest] = len(source) + np.cumsum(counts) - counts, counts
            source = np.concatenate([source, ids])
        ends = np.concatenate([[0], np.cumsum(count)])
        return spans(source, at, count), ends[np.searchsorted(word, offsets)]

    @staticmethod
    def _parts(buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each eight bytes of the words: which words reach there, and those bytes (zeros behind a word's end)."""
        eight = np.ndarray(len(buf) - 7, "<u8", buf, strides=(1,))
        out = []
        for k in range(0, 8 * EIGHTS, 8):
            rows = np.flatnonzero(size > k)
            out.append((rows, eight[at[rows] + k] & _MASK[np.minimum(size[rows] - k, 8)]))
        return out

    def _keys(self, buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        parts = self._parts(buf, at, size)
        key = size.astype(np.uint64) << np.uint64(56)
        for rows, part in parts:
            key[rows] = mix(key[rows] ^ part)
        return key, parts

    def encode_packed(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as packed little-endian integers of ``dtype``."""
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
        ids, bounds = self.encode_flat(np.frombuffer(b"".join(raw), np.uint8), offsets)
        out, ends = ids.tobytes(), (bounds * self.width).tolist()
        return [out[a:b] for a, b in zip(ends, ends[1:])]

    def forget(self) -> None:
        """Drop the memory of words; called when a task ends, so that a worker's
        memory is free for what it runs next."""
        self.memory = Memory(self.dtype)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_packed([text])[0], self.dtype)

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Special tokens are kept; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One codec, with its memory of words, per Python worker and file."""
    return Codec(path)


def text_groups(texts: list, max_chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts (null: empty) in groups of about ``max_chars``: (first index, texts)."""
    i = 0
    while i < len(texts):
        j, size, part = i, 0, []
        while j < len(texts) and (j == i or size < max_chars):
            part.append(texts[j] or "")
            size += len(part[-1])
            j += 1
        yield i, part
        i = j


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``id_col``, ids (array of int), n_tokens, ids_sha256 (hex digest of
    the decimal ids joined by commas) and decoded_sha256. Null texts are empty:
    no ids, the digests of nothing. Special tokens that stand in a text become
    their ids. Repeated rows are encoded each."""
    kind = docs.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        shown = [str(i) for i in range(len(c.bytes_of))]
        for batch in batches:
            for i, texts in text_groups(batch.column(1).to_pylist()):
                counts, digests, decoded = [], [], []
                for raw in c.encode_packed(texts):
                    ids = np.frombuffer(raw, c.dtype).tolist()
                    counts.append(len(ids))
                    digests.append(hashlib.sha256(",".join(map(shown.__getitem__, ids)).encode()).hexdigest())
                    back = c.decode_bytes(ids).decode("utf-8", "replace")
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(texts)), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                     pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        c.forget()

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def bpe_encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ids (array of int) of every whole text; a null text has none."""
    kind = docs.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            for i, texts in text_groups(batch.column(1).to_pylist()):
                ids = [np.frombuffer(raw, c.dtype).astype(np.int32) for raw in c.encode_packed(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(texts)), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])
        c.forget()

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and text of every row of ids; null ids give a null text."""
    kind = encoded.schema[id_col].dataType.simpleString()

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        for batch in batches:
            texts = [None if ids is None else c.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    return small_batches(encoded).select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).mapInArrow(
        run, f"id {kind}, text string").withColumnRenamed("id", id_col)
