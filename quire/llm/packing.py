"""Packing by lexical retrieval: neighbours of a seed document fill its window.

Documents are tokenised once and dealt into shards of similar documents (by
min-hashes of their token sets, a range each, so that no key's share matters).
Every shard has a BM25 inverted index over token ids, with document frequencies
of the whole corpus. The first unused document of a shard is the seed of a
window; the index returns its unused neighbours, best first, which fill the
window greedily. Whole documents go in as long as they fit; the one that does not is
cut to fill the window to the last token, and the rest of it stays in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.bpe import codec
from quire.llm.common import mix, small_batches, staged, text_slices, tidy

WINDOW = 2048
END_ID = 1                   # closes every document
K1, B = 1.2, 0.75            # the usual BM25 parameters
QUERY_TERMS = 24             # terms of a seed's query: those with the largest weights in it
NEIGHBOURS = 64              # neighbours taken from the index at a time
SHARD_TOKENS = 1 << 21       # tokens indexed together


def tokenised(texts: DataFrame, tokenizer: str, kind: str, end_id: int = END_ID) -> DataFrame:
    """(id, ids, n, near1, near2, df) of every row of ``texts`` (id, text): packed ids
    with the end id, their number and two min-hashes; and one row per task (ids
    null) with the document frequencies of all token ids in df."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(tokenizer)
        size = max(len(c.bytes_of), end_id + 1)
        hashes = [(mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(k)) >> np.uint64(33)).astype(np.int64) for k in (3, 7)]
        df, doc = np.zeros(size, np.int64), 0
        names = ["id", "ids", "n", "near1", "near2", "df"]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, j, buf, offsets in text_slices(batch):
                ids, bounds = c.encode_flat(buf, offsets)
                ids = np.insert(ids, bounds[1:], end_id)
                bounds += np.arange(j - i + 1)
                # Each document's distinct ids.
                wide, shift = (np.uint32, 16) if max(j - i, size) <= 1 << 16 else (np.uint64, 32)    # the least width that holds both
                key = (np.repeat(np.arange(j - i, dtype=wide), np.diff(bounds)) << wide(shift)) | ids
                key.sort()
                key = key[np.concatenate([[True], key[1:] != key[:-1]])]
                heads = np.searchsorted(key, np.arange(j - i, dtype=wide) << wide(shift))
                term = key & wide((1 << shift) - 1)
                df += np.bincount(term.astype(np.int64), minlength=size)
                doc += j - i
                packed = pa.Array.from_buffers(pa.binary(), j - i, [
                    None, pa.py_buffer((bounds * c.width).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(i, j - i), packed, pa.array(np.diff(bounds), pa.int64()),
                    *(pa.array(np.minimum.reduceat(h[term], heads), pa.int64()) for h in hashes),
                    pa.nulls(j - i, pa.list_(pa.int64()))], names)
        c.forget()
        if doc:
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, id_type), pa.nulls(1, pa.binary()), *(pa.nulls(1, pa.int64()) for _ in range(3)),
                pa.array([df], pa.list_(pa.int64()))], names)

    return texts.mapInArrow(run, f"id {kind}, ids binary, n long, near1 long, near2 long, df array<long>")


class Shard:
    """Items (document, first token, tokens left) with a BM25 inverted index of their documents."""

    def __init__(self, docs: list[tuple], idf: np.ndarray, mean: float):
        # docs: (id, ids, start) with less than a window of tokens from start on.
        self.docs = docs
        self.start = np.array([d[2] for d in docs], np.int64)
        self.left = np.array([len(d[1]) for d in docs], np.int64) - self.start
        self.used = np.zeros(len(docs), bool)
        tails = [d[1][d[2]:] for d in docs]
        owner = np.repeat(np.arange(len(docs), dtype=np.int64), self.left)
        wide, shift = (np.uint32, 16) if max(len(docs), len(idf)) <= 1 << 16 else (np.uint64, 32)    # the least width that holds both
        key = (owner.astype(wide) << wide(shift)) | np.concatenate(tails).astype(wide)
        key.sort()
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        tf, key = np.diff(np.append(heads, len(key))), key[heads]
        self.item, self.term = (key >> wide(shift)).astype(np.int64), (key & wide((1 << shift) - 1)).astype(np.int64)
        length = self.left[self.item] / mean
        self.weight = idf[self.term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length))
        self.row = np.searchsorted(self.item, np.arange(len(docs) + 1))
        # The inverted lists: entries by term.
        order = np.argsort(self.term, kind="stable")
        self.list_item, self.list_weight = self.item[order], self.weight[order]
        self.list_at = np.searchsorted(self.term[order], np.arange(len(idf) + 1))

    def neighbours(self, seed: int) -> Iterator[int]:
        """Unused items, best first: those that share a query term by BM25, then the others in order."""
        a, b = self.row[seed], self.row[seed + 1]
        terms, weight = self.term[a:b], self.weight[a:b]
        alone = self.list_at[terms + 1] - self.list_at[terms] < 2
        terms, weight = terms[~alone], weight[~alone]
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-weight, QUERY_TERMS)[:QUERY_TERMS]]
        spans = [slice(self.list_at[t], self.list_at[t + 1]) for t in terms]
        if spans:
            score = np.bincount(np.concatenate([self.list_item[s] for s in spans]),
                                np.concatenate([self.list_weight[s] for s in spans]), len(self.docs))
            score[self.used] = 0
            hit = np.flatnonzero(score > 0)
            while len(hit):
                few = hit[np.argpartition(-score[hit], NEIGHBOURS)[:NEIGHBOURS]] if len(hit) > NEIGHBOURS else hit
                few = few[np.lexsort((few, -score[few]))]
                for k in few.tolist():
                    if not self.used[k]:
                        yield k
                score[few] = 0
                hit = hit[score[hit] > 0]
        for k in np.flatnonzero(~self.used).tolist():
            if not self.used[k]:
                yield k

    def windows(self, window: int) -> Iterator[list[tuple[int, int, int]]]:
        """Windows as lists of (item, start, length); only the last may be short."""
        for seed in range(len(self.docs)):
            if self.used[seed]:
                continue
            made = [(seed, int(self.start[seed]), int(self.left[seed]))]
            self.used[seed] = True
            free = window - made[0][2]
            for k in self.neighbours(seed) if free else ():
                take = min(free, int(self.left[k]))
                made.append((k, int(self.start[k]), take))
                self.start[k] += take            # a neighbour that is too long is cut; its rest stays
                self.left[k] -= take
                self.used[k] = not self.left[k]
                free -= take
                if not free:
                    break
            yield made


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents in windows of ``window`` tokens.

    Per piece: ``id_col``, start (ids of the document before it), length, ids
    (packed little-endian unsigned 32-bit), doc_tokens (with the end id),
    sequence_id, offset (the piece's place in its sequence, gapless from 0).
    Every id of every document lies in exactly one piece; only the last sequence
    of a task is shorter than the window. Null texts are empty: the end id alone.
    Repeated rows are packed each. An empty table has no pieces."""
    texts = small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    made = staged(tokenised(texts, tokenizer, kind, end_id), "pack-tokens")
    rows = made.filter("ids is not null")
    total = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens")).first()
    counts = made.filter("ids is null").select(F.posexplode("df").alias("term", "df")).filter("df > 0").groupBy(
        "term").agg(F.sum("df").alias("df")).collect()     # at most one row per vocabulary entry
    size = max([r["term"] for r in counts], default=0) + 1
    df = np.zeros(size)
    for r in counts:
        df[r["term"]] = r["df"]
    n_docs, tokens = total["docs"], total["tokens"] or 0
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))
    mean = tokens / max(n_docs, 1)
    sent = docs.sparkSession.sparkContext.broadcast(idf)   # one number per vocabulary entry
    tasks = max(1, -(-tokens // SHARD_TOKENS))
    rows = rows.select("id", "ids", "near1", "near2", F.xxhash64("ids").alias("tie"))
    dealt = rows.repartitionByRange(
        tasks, "near1", "near2", "id", "tie").sortWithinPartitions("near1", "near2", "id", "tie") if tokens else rows

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype = codec(tokenizer).dtype
        sequence = TaskContext.get().partitionId() << 32
        out: list[tuple] = []
        held, size = [], 0
        id_type = None

        def emit(pieces: list[tuple]) -> None:
            nonlocal sequence
            at = 0
            for i, ids, start, length in pieces:
                out.append((i, start, length, ids[start:start + length].astype("<u4").tobytes(), len(ids), sequence, at))
                at += length
            sequence += 1

        def flush(last: bool) -> None:
            """Pack what is held; a window that is not full waits for the next shard."""
            nonlocal held, size
            shard = Shard(held, sent.value, mean)
            held, size = [], 0
            for window_ in shard.windows(window):
                pieces = [(shard.docs[k][0], shard.docs[k][1], start, length) for k, start, length in window_]
                if last or sum(p[3] for p in pieces) == window:
                    emit(pieces)
                else:
                    held += [(i, ids, start) for i, ids, start, _ in pieces]
                    size += sum(p[3] for p in pieces)

        def batch_of() -> pa.RecordBatch:
            kinds = [id_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            made_ = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out.clear()
            return made_

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, dtype)
                whole = len(ids) // window * window
                for start in range(0, whole, window):
                    emit([(i, ids, start, window)])
                    if len(out) >= 2000:
                        yield batch_of()
                if whole < len(ids):
                    held.append((i, ids, whole))
                    size += len(ids) - whole
                if size >= SHARD_TOKENS:
                    flush(False)
                    yield batch_of()
        if held:
            flush(True)
        if out:
            yield batch_of()

    return dealt.select("id", "ids").mapInArrow(
        run, f"id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    ).withColumnRenamed("id", id_col)
