"""Language identification by word-first backoff (operator 1).

A known word scores its log frequency in each language. An unseen word falls back to its character
n-grams, the longest ones of which at least half are known, then shorter ones, down to single
letters. A text's language is the one with the best mean over its words.

The model is fitted on a bounded, hash-chosen sample of labelled rows (DOCS_PER_LANG rows of a language and
SAMPLE_BYTES of text over all languages, in expectation), so it can be collected and sent to the executors whatever the
size of the table. Of that sample it has every language, and every word and n-gram that is used LEAST_USES times. Learning and
scoring cut words and n-grams by the same functions. A token is a 64-bit hash in a sorted array, and has entries for the
languages that use it only, so many languages cost no more room than their tokens.

Defined results: null texts and texts without a letter are `und` with score 0, and so is every text
when nothing was learned; equal languages go to the first by name; repeated rows each give a row;
a very long text is scored as a whole, in pieces that end between words; other columns are ignored; no rows
give no rows. A null doc_id hashes like an empty text and stays null.
"""

from __future__ import annotations

import collections
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .arrowtext import chunks, mix, powers, string_buffers, tidy
from .session import discard, written

#: Labelled rows of a language, and bytes of text over all languages, that the model learns from, in expectation.
DOCS_PER_LANG, SAMPLE_BYTES = 5000, 32 << 20
#: Uses in the sample from which on a word or n-gram is known.
LEAST_USES = 2
LONGEST_GRAM = 5
#: Numbers (words x languages) that a worker keeps of the words it has scored, and most words of these.
CACHE_NUMBERS, CACHE_WORDS = 1 << 22, 150_000
#: Most languages whose shares are broadcast; beyond it they are joined by a shuffle.
MOST_BROADCAST = 20_000
#: Words of evidence from which on more words do not make the score more certain.
EVIDENCE_WORDS = 20
#: Characters of a text that are split at once; words that are scored at once.
PIECE_CHARS, HELD_WORDS = 1 << 19, 200_000
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")
_EDGE = re.compile(r"[\W\d_]")
_U = np.uint64


def held_out(doc_id: Column, divisor: int, rest: int) -> Column:
    """Whether crc32(doc_id as text) mod divisor is `rest`."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor == rest


def words_of(text: str) -> Iterator[list[str]]:
    """The words of a text, some at a time: runs of letters in lower case."""
    at = 0
    while at < len(text):
        cut = _EDGE.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
        to = cut.start() + 1 if cut else len(text)
        found = _WORD.findall(text[at:to].lower())
        # the pattern also takes numbers that are no decimal digits
        yield found if text.isascii() else [w for w in found if w.isalpha() or any(map(str.isalpha, w))]
        at = to


class Tokens:
    """Keys of words, and of the n-grams of each word with an edge mark at both ends."""

    def __init__(self, words: list[str]):
        text = "".join(f"^{w}$" for w in words)
        self.letters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(_U) + _U(1)
        self.size = np.array([len(w) + 2 for w in words], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def words(self) -> np.ndarray:
        if not len(self.size):
            return np.zeros(0, _U)
        place = np.arange(len(self.letters)) - np.repeat(self.start, self.size)
        with np.errstate(over="ignore"):
            return mix(np.add.reduceat(mix(self.letters) * powers(int(self.size.max()))[place], self.start))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of every n-gram, word by word."""
        many = np.maximum(self.size - n + 1, 0)
        word = np.repeat(np.arange(len(self.size)), many)
        at = np.repeat(self.start - (np.cumsum(many) - many), many) + np.arange(many.sum())
        key = np.full(len(at), n, _U)
        with np.errstate(over="ignore"):
            for j in range(n):
                key = mix(key * _U(0x9E3779B97F4A7C15) + self.letters[at + j])
        return word, key


@dataclass
class LanguageModel:
    """Tokens by key, with a weight for each language that uses them; what an unused token scores in each language, by kind.

    Kinds: 0 is words, n the n-grams. Token i has the entries ptr[i] to ptr[i + 1] of language and weight.
    """

    languages: list[str]
    keys: list[np.ndarray]
    ptr: list[np.ndarray]
    language: list[np.ndarray]
    weight: list[np.ndarray]
    unused: np.ndarray

    def find(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are known, their tokens)."""
        own = self.keys[kind]
        if not len(own):
            return np.zeros(len(keys), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        known = own[at] == keys
        return known, at[known]

    def total(self, kind: int, row: np.ndarray, token: np.ndarray, rows: int) -> np.ndarray:
        """The sum of the tokens' weights by row and language."""
        ptr = self.ptr[kind]
        many = ptr[token + 1] - ptr[token]
        at = np.repeat(ptr[token] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        place = np.repeat(row, many) * len(self.languages) + self.language[kind][at]
        return np.bincount(place, self.weight[kind][at], rows * len(self.languages)).reshape(rows, len(self.languages))

    def scores(self, words: list[str]) -> np.ndarray:
        """Log frequency of each word in each language, by the first of word, 5-grams, ..., letters that knows it."""
        tokens = Tokens(words)
        out = np.zeros((len(words), len(self.languages)))
        known, token = self.find(0, tokens.words())
        row = np.flatnonzero(known)
        out[row] = self.total(0, np.arange(len(row)), token, len(row)) + self.unused[0]
        open_ = np.flatnonzero(~known)
        for n in range(LONGEST_GRAM, 0, -1):
            if not len(open_):
                break
            tokens = Tokens([words[i] for i in open_])
            word, key = tokens.grams(n)
            known, token = self.find(n, key)
            hits = np.bincount(word[known], minlength=len(open_))
            takes = (hits > 0) & ((2 * hits >= np.bincount(word, minlength=len(open_))) | (n == 1))
            new = np.cumsum(takes) - 1
            mine = takes[word[known]]
            got = self.total(n, new[word[known][mine]], token[mine], int(takes.sum()))
            out[open_[takes]] = got / hits[takes][:, None] + self.unused[n]
            open_ = open_[~takes]
        return out


def fit(labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG, sample_bytes: int = SAMPLE_BYTES) -> LanguageModel:
    """Learns from doc_id, text and lang of rows whose lang is not null."""
    rows = labelled.where(F.col("lang").isNotNull()).select(F.col("doc_id").cast("string"), F.col("text").cast("string"), F.col("lang").cast("string"))
    chance = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    sample = _share(rows.withColumn("chance", chance), F.least(F.lit(1.0), docs_per_lang / F.count(F.lit(1))))
    by_rows = written(sample.select("lang", "text", "chance"), "language-sample")
    languages = max(1, by_rows.select("lang").distinct().count())
    sample = _share(by_rows, F.least(F.lit(1.0), sample_bytes / (languages * F.greatest(F.sum(F.octet_length("text")), F.lit(1)))))
    counts = sample.mapInArrow(tidy(_token_counts), _COUNTS).groupBy("kind", "key", "lang").agg(F.sum("n").alias("n"))
    # a token has an entry a language at most
    known = counts.groupBy("kind", "key").agg(F.sum("n").alias("uses"), F.collect_list(F.struct("lang", "n")).alias("by_lang")).where(F.col("uses") >= LEAST_USES)
    model = build(known.select("kind", "key", F.col("by_lang.lang").alias("lang"), F.col("by_lang.n").alias("n")).toArrow())
    discard(by_rows)
    return model


def _share(rows: DataFrame, share: Column) -> DataFrame:
    """The rows whose chance is below the share of their language, which is an aggregate; their chance is even again."""
    shares = written(rows.groupBy("lang").agg(share.alias("share")), "language-shares")
    if shares.count() <= MOST_BROADCAST:
        shares = F.broadcast(shares)
    return rows.join(shares, "lang").where(F.col("chance") < F.col("share")).withColumn("chance", F.col("chance") / F.col("share")).drop("share")


_COUNTS = "kind int, key long, lang string, n long"


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Uses of words and n-grams by language."""
    for b in batches:
        lang, text = b.column("lang"), b.column("text").fill_null("")
        _, offsets = string_buffers(text)
        for i, j in chunks(offsets):
            uses: dict[str, collections.Counter] = {}
            for x, t in zip(lang.slice(i, j - i).to_pylist(), text.slice(i, j - i).to_pylist()):
                for words in words_of(t):
                    uses.setdefault(x, collections.Counter()).update(words)
            for x, words in uses.items():
                tokens, n = Tokens(list(words)), np.array(list(words.values()), np.int64)
                for kind in range(LONGEST_GRAM + 1):
                    word, key = tokens.grams(kind) if kind else (np.arange(len(n)), tokens.words())
                    distinct, place = np.unique(key, return_inverse=True)
                    total = np.bincount(place, n[word], len(distinct)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), kind, np.int32)), pa.array(distinct.view(np.int64)), pa.array([x]).take(pa.array(np.zeros(len(distinct), np.int64))), pa.array(total)], names=[c.split()[0] for c in _COUNTS.split(", ")])


def build(known: pa.Table) -> LanguageModel:
    """A model of a table of kind, key, and the languages and uses of each token; half a use is added everywhere."""
    known = known.combine_chunks()
    flat = lambda c: known[c].combine_chunks().flatten() if known.num_rows else pa.array([])
    code = flat("lang").dictionary_encode() if known.num_rows else pa.array([], pa.string()).dictionary_encode()
    names = code.dictionary.to_pylist()
    languages = sorted(names)
    place = np.array([languages.index(x) for x in names] or [0], np.int64)
    language, uses = place[code.indices.to_numpy().astype(np.int64)], flat("n").to_numpy(zero_copy_only=False).astype(np.float64)
    kind, key = known["kind"].to_numpy(), known["key"].to_numpy().astype(np.int64).view(_U)
    size = known["lang"].combine_chunks().value_lengths().to_numpy().astype(np.int64) if known.num_rows else np.zeros(0, np.int64)
    start = np.cumsum(size) - size
    keys, ptr, languages_of, weight, unused = [], [], [], [], np.zeros((LONGEST_GRAM + 1, len(languages)))
    for k in range(LONGEST_GRAM + 1):
        own = np.flatnonzero(kind == k)
        own = own[np.argsort(key[own])]
        many = size[own]
        at = np.repeat(start[own] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        total = np.bincount(language[at], uses[at], len(languages)) + 0.5 * len(own)
        unused[k] = np.log(0.5 / np.maximum(total, 0.5))
        keys.append(key[own])
        ptr.append(np.concatenate([[0], np.cumsum(many)]))
        languages_of.append(language[at].astype(np.int32))
        weight.append(np.log((uses[at] + 0.5) / 0.5).astype(np.float32))
    return LanguageModel(languages, keys, ptr, languages_of, weight, unused)


class Scorer:
    """Scores texts; what it has worked out for words is kept in a table of bounded size."""

    def __init__(self, model: LanguageModel):
        self.model, self.width = model, max(1, len(model.languages))
        self.most = max(256, min(CACHE_WORDS, CACHE_NUMBERS // self.width))
        self.table = np.zeros((0, self.width), np.float32)
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        at = len(self.known)
        if at + len(new) > len(self.table):
            room = np.zeros((min(self.most, 2 * (at + len(new))), self.width), np.float32)
            room[:at] = self.table[:at]
            self.table = room
        step = max(64, CACHE_NUMBERS // 8 // self.width)
        for i in range(0, len(new), step):
            part = new[i : i + step]
            self.table[at + i : at + i + len(part)] = self.model.scores(part)
        self.known.update(zip(new, range(at, at + len(new))))

    def totals(self, pieces: list[list[str]]) -> np.ndarray:
        """The sum of the words' scores of each piece by language."""
        distinct = set().union(*pieces)
        new = [w for w in distinct if w not in self.known]
        if len(self.known) + len(new) > self.most:
            self.known, new = {}, list(distinct)
            if len(new) > self.most:  # more than the table has room for
                if len(pieces) > 1:
                    half = len(pieces) // 2
                    return np.concatenate([self.totals(pieces[:half]), self.totals(pieces[half:])])
                half = len(pieces[0]) // 2
                return self.totals([pieces[0][:half]]) + self.totals([pieces[0][half:]])
        if new:
            self._learn(sorted(new))
        out, step = np.zeros((len(pieces), self.width)), max(64, CACHE_NUMBERS // 8 // self.width)
        for k, words in enumerate(pieces):
            rows = list(map(self.known.__getitem__, words))
            for i in range(0, len(rows), step):
                out[k] += self.table[rows[i : i + step]].sum(axis=0, dtype=np.float64)
        return out

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        total, n = np.zeros((len(texts), self.width)), np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush() -> None:
            nonlocal held
            got = self.totals([words for _, words in waiting])
            for (k, words), row in zip(waiting, got):
                total[k] += row
                n[k] += len(words)
            waiting.clear()
            held = 0

        for k, text in enumerate(texts if self.model.languages else ()):
            for words in words_of(text or ""):
                if words:
                    waiting.append((k, words))
                    held += len(words)
                    if held > HELD_WORDS:
                        flush()
        if waiting:
            flush()
        mean = total / np.maximum(n, 1)[:, None]
        odds = np.exp((mean - mean.max(axis=1, keepdims=True)) * np.minimum(n, EVIDENCE_WORDS)[:, None])
        best = mean.argmax(axis=1)
        score = odds[np.arange(len(texts)), best] / odds.sum(axis=1)
        return [(self.model.languages[b], float(s)) if m else (UNDETERMINED, 0.0) for b, s, m in zip(best.tolist(), score.tolist(), n.tolist())]


def _predictions(shared, text: pa.Array, scorer: Scorer | None) -> tuple[list[tuple[str, float]], Scorer]:
    scorer = scorer or Scorer(shared.value)
    _, offsets = string_buffers(text)
    return [x for i, j in chunks(offsets) for x in scorer.predict(text.slice(i, j - i).to_pylist())], scorer


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred and score of every row; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for b in batches:
            found, scorer = _predictions(shared, b.column("text"), scorer)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidy(run), "doc_id long, lang_pred string, score double")


def keep(docs: DataFrame, model: LanguageModel, least: float) -> DataFrame:
    """The rows with a language and a score of at least `least`, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for b in batches:
            found, scorer = _predictions(shared, b.column(b.schema.get_field_index("text")), scorer)
            yield b.filter(pa.array([x != UNDETERMINED and p >= least for x, p in found], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)


def evaluate(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts every row, with held_out."""
    model = fit(docs.where(~held_out(F.col("doc_id"), 3, 1)))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")
