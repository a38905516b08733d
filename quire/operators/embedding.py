"""Embedding text, candidates, batched model calls and write-back (O-47, O-58, O-89 … O-92)."""

from __future__ import annotations

import queue
import threading
import time
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the text rule.
AUTHOR_ROLE = "A01"
LONG_DESCRIPTION_CHARS = 500


def ordered_join(child: DataFrame, key, value: str, order: Sequence[str], sep: str = ", ",
                 where: Column | None = None, alias: str = "joined") -> DataFrame:
    """O-58: per key, the non-empty ``value``s in ``order`` joined with ``sep``.

    The list is per parent (a book's authors or subjects), so it stays small.
    """
    keys = [key] if isinstance(key, str) else list(key)
    c = child if where is None else child.where(where)
    c = c.where(F.coalesce(F.col(value), F.lit("")) != "")
    packed = F.struct(*[F.col(o) for o in order], F.col(value).alias("__v"))
    return (c.groupBy(*keys)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(packed)), lambda x: x["__v"]), sep)
                 .alias(alias)))


def text_parts(title, subtitle, authors, subjects, short_description, long_description) -> Column:
    """O-89: the parts, blanks dropped, joined with ``'. '``."""
    by = F.when(F.coalesce(authors, F.lit("")) != "", F.concat(F.lit("By "), authors))
    desc = F.coalesce(short_description, F.substring(long_description, 1, LONG_DESCRIPTION_CHARS))
    parts = [title, subtitle, by] + ([subjects] if subjects is not None else []) + [desc]
    return F.array_join(F.filter(F.array(*parts), lambda x: x.isNotNull() & (x != "")), ". ")


def embedding_text_nested(products: DataFrame, subjects: bool = True) -> Column:
    """O-89 on a nested product row (contributors/subjects arrays, file order)."""
    authors = F.array_join(F.transform(
        F.filter("contributors", lambda c: (c["role"] == AUTHOR_ROLE) & (F.coalesce(c["person_name"], F.lit("")) != "")),
        lambda c: c["person_name"]), ", ")
    heads = F.array_join(F.transform(
        F.filter("subjects", lambda s: F.coalesce(s["subject_heading_text"], F.lit("")) != ""),
        lambda s: s["subject_heading_text"]), ", ") if subjects else None
    return text_parts(F.col("title"), F.col("subtitle"), authors, heads, F.col("short_description"),
                      F.col("long_description"))


def embedding_text(books: DataFrame, contributors: DataFrame, book_subjects: DataFrame | None = None,
                   key: str = "record_reference") -> DataFrame:
    """O-89 / O-90 on flat catalogue tables: ``key, text``.

    Without ``book_subjects`` this is the backfill text (O-90), which leaves
    subjects out.
    """
    a = ordered_join(contributors, key, "person_name", ["sequence_number", "person_name"],
                     where=F.col("role") == AUTHOR_ROLE, alias="__authors")
    b = books.join(a, key, "left")
    subj = None
    if book_subjects is not None:
        s = ordered_join(book_subjects, key, "subject_heading_text", ["pos"], alias="__subjects")
        b = b.join(s, key, "left")
        subj = F.col("__subjects")
    return b.select(key, text_parts(F.col("title"), F.col("subtitle"), F.col("__authors"), subj,
                                    F.col("short_description"), F.col("long_description")).alias("text"))


def needs_embedding(books: DataFrame, touched: DataFrame, key: str = "record_reference") -> DataFrame:
    """O-47: touched books without a current embedding (``embedded_at`` null)."""
    return books.join(touched.select(key).distinct(), key, "left_semi").where(F.col("embedded_at").isNull())


def backfill_candidates(books: DataFrame) -> DataFrame:
    """O-90: books with no vector at all (``embedding`` null, not ``embedded_at``)."""
    return books.where(F.col("embedding").isNull())


def hashing_provider(dim: int) -> Callable[[list[str]], list[list[float] | None]]:
    """Deterministic offline model: hashed bag of words, L2-normalised.

    Empty text fails (returns None), like a model refusing empty input.
    """
    def embed(texts: list[str]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for t in texts:
            words = (t or "").lower().split()
            if not words:
                out.append(None)
                continue
            v = np.zeros(dim, dtype=np.float32)
            for w in words:
                h = zlib.crc32(w.encode("utf-8"))
                v[h % dim] += 1.0 if (h >> 16) & 1 else -1.0
            n = float(np.linalg.norm(v))
            out.append((v / n if n else v).tolist())
        return out
    return embed


def call_within(call: Callable[[list[str]], list], texts: list[str], seconds: float) -> list:
    """``call(texts)``, or a TimeoutError after ``seconds``. The call runs in a thread of its own that is
    left behind when it hangs; as a daemon it does not keep the worker from ending."""
    done: queue.Queue = queue.Queue(1)

    def work() -> None:
        try:
            done.put((call(texts), None))
        except Exception as e:  # noqa: BLE001 - handed to the caller
            done.put((None, e))
    threading.Thread(target=work, daemon=True).start()
    try:
        out, error = done.get(timeout=seconds)
    except queue.Empty:
        raise TimeoutError(f"no answer within {seconds} s") from None
    if error is not None:
        raise error
    return out


class RetryingProvider:
    """O-91 call discipline around a batch model call, run inside each task:
    up to ``tries`` attempts of at most ``deadline`` seconds each, back-off 1-2-4-8 s (or the server's
    hint plus 2 s when the error carries ``retry_after``), a pause between batches.
    A batch whose last attempt fails or hangs has null vectors, so its books stay unembedded.
    ``sleep`` is injectable so tests do not wait."""

    def __init__(self, call: Callable[[list[str]], list], tries: int = 5, backoff: Sequence[float] = (1, 2, 4, 8),
                 pause: float = 0.0, sleep: Callable[[float], None] | None = None, deadline: float | None = 60.0):
        self.call, self.tries, self.backoff, self.pause = call, tries, tuple(backoff), pause
        self.sleep, self.deadline = sleep or time.sleep, deadline
        self._calls = 0

    def __call__(self, texts: list[str]) -> list:
        if self._calls and self.pause:
            self.sleep(self.pause)
        self._calls += 1
        for attempt in range(self.tries):
            try:
                return self.call(texts) if self.deadline is None else call_within(self.call, texts, self.deadline)
            except Exception as e:  # noqa: BLE001 - any transport/model error is retried
                if attempt == self.tries - 1:
                    return [None] * len(texts)      # give up: the batch's books stay unembedded
                hint = getattr(e, "retry_after", None)
                wait = hint + 2 if hint is not None else self.backoff[min(attempt, len(self.backoff) - 1)]
                self.sleep(wait)
        return [None] * len(texts)


def embed(texts: DataFrame, provider: Callable[[list[str]], list], dim: int, batch: int = 100,
          key: str = "record_reference", text: str = "text", calls_per_minute: float | None = None,
          tasks: int | None = None) -> DataFrame:
    """O-91: ``key, embedding`` by calling ``provider`` on batches of ``batch`` texts.

    Runs in ``mapInPandas``: each task sends its own batches. With ``calls_per_minute`` the texts
    are dealt to ``tasks`` tasks (by default as many as run at once) and each of them begins at most
    its share of the calls, so that the run as a whole keeps to the rate. The provider owns
    retries/back-off (its repeated tries are not counted); a failed text gives a null vector.
    """
    texts, least = texts.select(key, text), 0.0
    if calls_per_minute is not None:
        tasks = tasks or texts.sparkSession.sparkContext.defaultParallelism
        texts, least = texts.repartition(tasks), 60.0 * tasks / calls_per_minute
    schema = T.StructType([T.StructField(key, texts.schema[key].dataType),
                           T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        due = None          # when this task may call again
        for pdf in it:
            for s in range(0, len(pdf), batch):
                part = pdf.iloc[s:s + batch]
                if due is not None and least:
                    time.sleep(max(0.0, due - time.monotonic()))
                due = time.monotonic() + least
                vecs = provider(part[text].tolist())
                yield pd.DataFrame({key: part[key].values, "embedding": vecs})

    return texts.mapInPandas(run, schema)


def write_vectors(books: DataFrame, vectors: DataFrame, dim: int, as_of, key: str = "record_reference",
                  touch_updated: bool = False) -> DataFrame:
    """O-92: store vectors of the right size and stamp ``embedded_at``;
    missing/empty/wrong-size vectors leave the book as it was."""
    ts = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    v = vectors.select(key, F.col("embedding").alias("__v"))
    j = books.join(v, key, "left")
    ok = F.coalesce(F.size("__v") == dim, F.lit(False))
    cols = []
    for c in books.columns:
        if c == "embedding":
            cols.append(F.when(ok, F.col("__v")).otherwise(F.col(c)).alias(c))
        elif c == "embedded_at":
            cols.append(F.when(ok, ts).otherwise(F.col(c)).alias(c))
        elif c == "updated_at" and touch_updated:
            cols.append(F.when(ok, ts).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)
