"""Language identification by cross-parsing entropy.

All words of all labelled texts are counted; those that a language uses most
often are its sample text. A suffix automaton of it gives, at any place of a text,
the longest match with that language's sample. Parsing a text greedily into
longest matches takes few phrases in its own language and many in others; the
language that needs the fewest normalised phrases, ``phrases * log2(sample
length) / text length``, wins.

All blocks of all texts of a slice are parsed side by side, one character a
step, as array look-ups in the automata's transition tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.common import id_remainder, small_batches, text_slices, tidy

SAMPLE_CHARS = 16_384   # characters of a language's most frequent words that the automaton holds
HELD_ROWS = 4_096       # held-out texts that are mixed with one another
BLOCK = 1_024           # texts are parsed in blocks of so many characters, each from its start
TABLE_LETTERS = 64      # a language of more symbols than these is a sorted list of transitions, not a table
BESIDES = 32            # phrases that any text may have above its rate: a token or an address of some 40 symbols
UNDETERMINED = "und"

# A word is a run of letters, in pieces of at most 16; of 3 in scripts that leave no spaces.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[\p{{L}}&&[{_UNSPACED}]]{{1,3}}|[\p{{L}}&&[^{_UNSPACED}]]{{1,16}}"

_FLAG = np.uint32(1 << 31)


@lru_cache(maxsize=1)
def _cased() -> list[tuple[int, str]]:
    """Code points with another lower-case letter, and that letter."""
    return [(p, low) for p in range(0x110000) if (low := chr(p).lower()) != chr(p) and len(low) == 1]


class Automata:
    """Suffix automata of all languages over one set of symbols.

    Symbol 0 is any run of non-letters, symbol 1 any letter that no sample
    holds; every other letter, in lower case, is a symbol of its own. A language
    of few letters is a table whose rows are its states and whose columns are
    its own letters and one for all others; one of many letters (zh, ja, ko) is
    a sorted list of its transitions. An entry is the next state (in a table,
    where its row begins); its high bit says that a phrase ended and the
    character began the next one."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.fold = np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.uint32, 0x110000)
        lower = dict(_cased())
        letters = sorted({lower.get(ord(c), c) for _, text in samples for c in set(text) if c.isalpha()})
        self.width = len(letters) + 2
        for k, c in enumerate(letters):
            self.fold[ord(c)] = k + 2
        for p, c in lower.items():
            if self.fold[p]:
                self.fold[p] = self.fold[ord(c)]
        self.names = [name for name, _ in samples]
        tables, columns, at = [], [], 0
        self.lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []    # keys, next states, where a phrase begins
        starts, deads, kinds, sizes = [], [], [], []
        for _, text in samples:
            symbols = self.symbols(text)
            own, narrow = np.unique(symbols, return_inverse=True)
            # One more state, behind a character that the sample never holds: such a
            # character is a phrase of its own, wherever it stands.
            if dense := len(own) <= TABLE_LETTERS:
                width = len(own) + 1
                table = _table(_suffix_automaton(narrow), width)
                dead = len(table)
                begin = np.where(table[0] >= 0, table[0], dead)     # where a new phrase stands
                full = np.vstack([np.where(table >= 0, table, begin[None, :]), begin]).astype(np.uint32)
                full *= np.uint32(width)
                full += np.uint32(at)
                full[1:dead][table[1:] < 0] |= _FLAG
                full[dead] |= _FLAG
                tables.append(full.ravel())
                column = np.full(self.width, len(own), dtype=np.uint32)
                column[own] = np.arange(len(own))
                columns.append(column)
                starts.append(at)
                deads.append(at + dead * width)
                at += (dead + 1) * width
            else:
                nxt = _suffix_automaton(symbols)
                dead = len(nxt)
                moves = sorted((s * self.width + c, t) for s, row in enumerate(nxt) for c, t in row.items())
                begin = np.full(self.width, dead, dtype=np.uint32)
                begin[list(nxt[0])] = list(nxt[0].values())
                self.lists.append((np.array([k for k, _ in moves], np.int64), np.array([t for _, t in moves], np.uint32), begin))
                starts.append(0)
                deads.append(dead)
            kinds.append(not dense)
            sizes.append(len(symbols))
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.uint32)
        self.columns = np.array(columns, dtype=np.uint32).reshape(len(columns), self.width)
        self.order = np.argsort(kinds, kind="stable").astype(np.int64)      # tables come first
        self.starts = np.array(starts, dtype=np.uint32)[self.order]
        self.deads = np.array(deads, dtype=np.uint32)[self.order]
        self.bits = np.array([np.log2(max(n, 2)) for n in sizes])

    def symbols(self, text: str) -> np.ndarray:
        s = self.fold[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
        return s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])] if len(s) else s

    def slice_symbols(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols of all texts, bounds, letters per text); a run of non-letters is one symbol."""
        points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        heads = np.zeros(len(buf) + 1, dtype=np.int64)
        np.cumsum((buf & 0xC0) != 0x80, out=heads[1:])
        bounds = heads[offsets]
        s = self.fold[points]
        keep = np.ones(len(s), dtype=bool)
        if len(s):
            keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
            keep[bounds[:-1][bounds[:-1] < len(s)]] = True
        kept, letters = np.zeros(len(s) + 1, np.int64), np.zeros(len(s) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        np.cumsum(s != 0, out=letters[1:])
        return s[keep], kept[bounds], letters[bounds[1:]] - letters[bounds[:-1]]

    def step(self, state: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Entries of ``state`` (languages in ``order``, blocks) at the blocks' symbols ``c``."""
        n = len(self.columns)
        if not self.lists:
            return self.table[state + self.columns[:, c]]
        out = np.empty_like(state)
        if n:
            out[:n] = self.table[state[:n] + self.columns[:, c]]
        for j, (keys, nxt, begin) in enumerate(self.lists, n):
            key = state[j].astype(np.int64) * self.width + c
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out[j] = np.where(keys[at] == key, nxt[at], begin[c] | np.where(state[j] != 0, _FLAG, np.uint32(0)))
        return out

    def phrases(self, symbols: np.ndarray, bounds: np.ndarray, mixed: bool = False) -> np.ndarray:
        """Phrases that each text needs in each language: (texts, languages).

        With ``mixed`` a last column: the phrases it needs if each may be of any language."""
        langs = len(self.names)
        sizes, begin, length, owner = _blocks(bounds)
        state = np.repeat(self.starts[:, None], len(owner), axis=1)
        both = state.copy()
        ended = np.ones((langs + mixed, len(owner)), dtype=np.uint32)     # the phrase that is open at a block's end
        alive = np.searchsorted(-length, -np.arange(BLOCK), side="left")   # blocks longer than t
        for t in range(int(length[0]) if len(length) and langs else 0):
            k = alive[t]
            c = symbols[begin[:k] + t]
            v = self.step(state[:, :k], c)
            ended[:langs, :k] += v >> np.uint32(31)
            state[:, :k] = v & ~_FLAG
            if mixed:
                # A language whose match has ended waits in its dead state until all have.
                v = self.step(both[:, :k], c)
                over = v >= _FLAG
                last = over.all(axis=0)
                ended[langs, :k] += last
                both[:, :k] = np.where(over & ~last, self.deads[:, None], v & ~_FLAG)
        out = np.zeros((len(sizes), langs + mixed))
        np.add.at(out, owner, ended[np.concatenate([np.argsort(self.order), np.arange(langs, langs + mixed)])].T)
        return out

    def together(self, symbols: np.ndarray, bounds: np.ndarray, rate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The phrases that each text needs if each may be of any language, and the most that
        any passage of it has above the text's ``rate`` times its symbols."""
        sizes, begin, length, owner = _blocks(bounds)
        state, per = np.repeat(self.starts[:, None], len(owner), axis=1), rate[owner]
        # Of each block: phrases, all above the rate, the most of a beginning, of an end, and of any passage.
        count, total, first, last, most = np.zeros((5, len(owner)))
        alive = np.searchsorted(-length, -np.arange(BLOCK), side="left")
        for t in range(int(length[0]) if len(length) and self.names else 0):
            k = alive[t]
            v = self.step(state[:, :k], symbols[begin[:k] + t])
            over = v >= _FLAG
            ended = over.all(axis=0) | (t == 0)
            state[:, :k] = np.where(over & ~ended, self.deads[:, None], v & ~_FLAG)
            count[:k] += ended
            more = ended - per[:k]
            total[:k] += more
            first[:k] = np.maximum(first[:k], total[:k])
            last[:k] = np.maximum(last[:k], 0) + more
            most[:k] = np.maximum(most[:k], last[:k])
        phrases, best = np.zeros((2, len(sizes)))
        np.add.at(phrases, owner, count)
        open_, text = 0.0, -1
        for b in np.lexsort((begin, owner)).tolist():       # blocks in the order of the texts
            if owner[b] != text:
                open_, text = 0.0, owner[b]
            best[text] = max(best[text], most[b], open_ + first[b])
            open_ = max(last[b], open_ + total[b], 0.0)
        return phrases, best

    def rates(self, buf: np.ndarray, offsets: np.ndarray, mixed: bool = False
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Normalised phrases (bits a character) of each text in each language,
        whether it has letters, how many symbols were parsed, and (``mixed``; else
        0) its phrases if each may be of any language."""
        symbols, bounds, letters = self.slice_symbols(buf, offsets)
        n, langs = np.diff(bounds), len(self.names)
        count = self.phrases(symbols, bounds, mixed)
        return (count[:, :langs] * self.bits[None, :] / np.maximum(n, 1)[:, None], letters > 0, n,
                count[:, langs] if mixed else np.zeros(len(n)))


def _blocks(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the texts; begin, length and text of their blocks, the longest first."""
    sizes = np.diff(bounds)
    per = -(-sizes // BLOCK)
    owner = np.repeat(np.arange(len(sizes)), per)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    begin = bounds[:-1][owner] + (np.arange(len(owner)) - first[owner]) * BLOCK
    length = np.minimum(bounds[1:][owner] - begin, BLOCK)
    order = np.argsort(-length, kind="stable")
    return sizes, begin[order], length[order], owner[order]


def _suffix_automaton(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state of the suffix automaton."""
    nxt: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in symbols.tolist():
        cur = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if size[p] + 1 == size[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return nxt


def _table(nxt: list[dict[int, int]], width: int) -> np.ndarray:
    """Transition table (states, width); -1 where there is none."""
    table = np.full((len(nxt), width), -1, dtype=np.int32)
    for s, row in enumerate(nxt):
        for c, t in row.items():
            table[s, c] = t
    return table


@lru_cache(maxsize=2)
def automata(samples: tuple[tuple[str, str], ...]) -> Automata:
    """Built once per Python worker from the (small) samples."""
    return Automata(samples)


def _labelled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, holdout: tuple[int, int], held: bool) -> DataFrame:
    """(id, lang, text) of all labelled rows with a letter, of the holdout or outside it; texts are whole."""
    inside = id_remainder(F.col("id"), holdout[0]) == holdout[1]
    return docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (inside if held else ~inside))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          holdout: tuple[int, int] = (4, 2)) -> tuple[tuple[str, str], ...]:
    """Sample text of every language: its most frequent words, the most frequent first.

    The words of all whole labelled texts outside the holdout are counted (ties go by
    hash). Only the model's size is bounded: SAMPLE_CHARS characters a language."""
    known = _labelled(docs, id_col, text_col, lang_col, holdout, held=False)
    words = F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))
    counts = known.select("lang", F.explode(words).alias("word")).groupBy("lang", "word").count()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), F.xxhash64("word"), "word"))
    rows = counts.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_CHARS // 2).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["word"])
    return tuple((lang, " ".join(found)[:SAMPLE_CHARS]) for lang, found in sorted(out.items()))


def limits(docs: DataFrame, samples: tuple[tuple[str, str], ...], id_col: str = "doc_id", text_col: str = "text",
           lang_col: str = "lang", holdout: tuple[int, int] = (4, 2)) -> tuple[dict[str, float], float]:
    """(phrases a symbol by language, phrases besides), from all labelled rows of the
    holdout: a text with more ``phrases`` than ``n_symbols`` times its language's rate and
    those besides is in none of them.

    The rate lies midway between texts that change language with every word, and
    the same with their letters in random order (the median, to 4 decimals); the language it
    is mixed with is the one that gives the highest. Besides come the most phrases that any
    passage of a labelled text has above its language's rate: an
    address or a token in it is no other language. They are BESIDES at least, for
    labelled texts may hold none. Languages without held-out texts have no rate."""
    held = _labelled(docs, id_col, text_col, lang_col, holdout, held=True).filter(
        F.col("lang").isin([name for name, _ in samples])).select("lang", "text", F.xxhash64("id", "text").alias("seed"))
    dealt = held.repartition(max(1, -(-held.count() // HELD_ROWS)), "seed").sortWithinPartitions("seed", "lang", "text")
    found = small_batches(dealt).mapInArrow(_rates(samples), "lang string, other string, rate double")
    medians = found.groupBy("lang", "other").agg(F.percentile(F.round("rate", 4), F.lit(0.5)).alias("rate"))
    rates = {r["lang"]: r["rate"] for r in medians.groupBy("lang").agg(F.max("rate").alias("rate")).collect()}
    most = small_batches(held).mapInArrow(_besides(samples, rates), "most double").agg(F.max("most")).first()[0]
    return rates, max(float(BESIDES), most or 0.0)


def _rates(samples: tuple[tuple[str, str], ...]):
    """Of each text of a slice, mixed with one in another language: languages and rate."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automata(samples)
        for batch in batches:
            for i, j, _, _ in text_slices(batch, max_bytes=1 << 21):
                names, texts, seeds = (batch.column(c).slice(i, j - i).to_pylist() for c in range(3))
                held: dict[str, list[tuple[list[str], int]]] = {}
                for name, text, seed in zip(names, texts, seeds):
                    held.setdefault(name, []).append((text.split(), seed))
                langs, pairs, parsed, shuffled = sorted(held), [], [], []
                for k, name in enumerate(langs):
                    for at, (words, seed) in enumerate(held[name]):
                        other = langs[(k + 1 + at % max(len(langs) - 1, 1)) % len(langs)]
                        more = held[other][at % len(held[other])][0]
                        both = [w for pair in zip(words, more) for w in pair] if other != name else words
                        pairs.append((name, other))
                        parsed.append(model.symbols(" ".join(both)))
                        shuffled.append(np.random.default_rng(seed & (1 << 63) - 1).permutation(parsed[-1]))
                bounds = np.cumsum([0, *map(len, parsed)])
                own, mixed = (model.together(np.concatenate(x), bounds, np.zeros(len(x)))[0] for x in (parsed, shuffled))
                yield pa.RecordBatch.from_arrays([
                    pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string()),
                    pa.array((own + mixed) / 2 / np.maximum(np.diff(bounds), 1))], ["lang", "other", "rate"])
    return run


def _besides(samples: tuple[tuple[str, str], ...], rates: dict[str, float]):
    """The most phrases that any passage of a slice's texts has above its language's rate."""
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automata(samples)
        for batch in batches:
            for i, j, buf, offsets in text_slices(batch, max_bytes=1 << 21):
                symbols, bounds, _ = model.slice_symbols(buf, offsets)
                rate = np.array([rates[name] for name in batch.column(0).slice(i, j - i).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array([model.together(symbols, bounds, rate)[1].max()])], ["most"])
    return run


def predict(docs: DataFrame, samples: tuple[tuple[str, str], ...], columns: list[str], text_col: str = "text",
            prefix: str = "", mixed: bool = False) -> DataFrame:
    """``columns`` of every row, lang_pred, score, bits and n_symbols (their names after ``prefix``).

    lang_pred: the language with the fewest normalised phrases (``und`` for a
    null text, one without a letter, or if there is no sample); ties go to the
    first name. score: how much worse the second language is, second / (first +
    second), 0 for ``und``. bits: the winner's bits a character (null for ``und``).
    n_symbols: characters that were parsed (a run of non-letters is one). phrases:
    (``mixed`` only) how many the text takes if each may be of any language."""
    more = ["lang_pred", "score", "bits", "n_symbols", *(["phrases"] if mixed else [])]
    names = [f"c{k}" for k in range(len(columns))]
    text = names[columns.index(text_col)] if text_col in columns else "__text"

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = automata(samples)
        labels = np.array([*model.names, UNDETERMINED], dtype=object)
        for batch in batches:
            for i, j, buf, offsets in text_slices(batch, text, max_bytes=1 << 21):
                rate, lettered, n, both = model.rates(buf, offsets, mixed)
                if not model.names:
                    lettered[:] = False
                    rate = np.ones((len(lettered), 1))
                best = np.where(lettered, rate.argmin(axis=1), len(model.names))
                two = np.sort(rate, axis=1)[:, :2]
                share = two[:, 1] / np.maximum(two.sum(axis=1), 1e-12) if two.shape[1] == 2 else np.ones(len(rate))
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(i, j - i) for k in range(len(names))), pa.array(labels[best], pa.string()),
                    pa.array(np.where(lettered, share, 0.0)), pa.array(two[:, 0], mask=~lettered), pa.array(n),
                    *([pa.array(both)] if mixed else [])], [*names, *more])

    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    sent = [F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)]
    out = small_batches(docs).select(*sent, *([] if text in names else [F.col(f"`{text_col}`").alias(text)])).mapInArrow(
        run, ", ".join([*(f"{n} {k}" for n, k in zip(names, kinds)), "lang_pred string, score double, bits double, n_symbols long",
                         *(["phrases double"] if mixed else [])]))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, columns)),
                      *(F.col(c).alias(prefix + c) for c in more))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col``, held_out, lang_pred, score and bits of every row.

    Only the text decides; ids and labels choose what is learned from. Null ids are never
    learned from. Repeated rows are predicted each; an empty table is fine."""
    out = predict(docs, learn(docs, id_col, text_col, lang_col), [id_col], text_col)
    held = F.coalesce(id_remainder(F.col(id_col), 4) == 2, F.lit(False))
    return out.select(id_col, held.alias("held_out"), "lang_pred", "score", "bits")
