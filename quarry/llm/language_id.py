"""Language identification: unigram piece models, marginalised over all segmentations.

Every language has a probability for each piece of a fixed public vocabulary.  A
word's probability is the sum, over all ways to cut it into pieces, of the
products of their probabilities, by the forward algorithm; a text's is the product
over its words.  Words are runs of letters in lower case with a mark in front, as
the vocabulary writes them.  Characters no piece holds cost a fixed factor, alike
for all languages.

Learning: the words of all learning documents are counted by language (each task
counts its own first); the piece probabilities are fitted to those counts by
ROUNDS rounds of expectation-maximisation, with the expected counts of
forward-backward summed over the table of words, which holds each word of a
language once.  A language needs no minimum of documents.  The vocabulary is a
file of fixed size, so the models are bounded by it and the number of languages
(at most MAX_LANGUAGES, or an error).

Scoring: the posterior of the languages given the word probabilities, with the
documents' shares as prior, of the whole text.

Results: null texts and texts without a letter are ``und`` with score 0; equal
posteriors go to the first language in order; rows with null lang or id are scored
but not (null lang) learned from; an empty learning table makes every text ``und``
with score 0; repeated rows get equal results; very long texts are read whole, in chunks cut between
words; columns other than doc_id, text and lang, of any name, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import kept_table, learn_fold, map_texts, slices, small_batches, temporary_tables

MARK = "▁"
LONGEST = 16  # characters of a piece
LONGEST_WORD = 32  # longer runs of letters are scored in parts of this length
ROUNDS = 2
SMOOTHING = 0.1  # expected count added to each piece
UNKNOWN = -10.0  # log factor of a character that is in no piece
MAX_LANGUAGES = 200
CACHED = 200_000
CHUNK = 1 << 18  # characters that are split into words at a time
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_BETWEEN = regex.compile(r"[^\p{L}\p{M}]")
#: The first 256 characters, with a space for each that is no letter (there are no marks among them).
_LATIN = bytes(k if _LETTERS.fullmatch(chr(k)) else 32 for k in range(256))


def pieces_of(path: str) -> list[str]:
    """The vocabulary's pieces in order: no control, byte or unknown pieces, lower case only, single pieces of the mark alone."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.vocab_size())
    names = [model.id_to_piece(i) for i in every if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    return [p for p in dict.fromkeys(names) if p == p.lower() and MARK not in p[1:] and (p == MARK or _LETTERS.fullmatch(p.lstrip(MARK)))]


def _found(text: str) -> list[str]:
    """The matches of _LETTERS in a text."""
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _LETTERS.findall(text)


def words_of(text: str) -> Iterator[list[str]]:
    """Runs of letters of a whole text, lower case, chunk by chunk (cut only between words)."""
    text = text.lower()
    start, n = 0, len(text)
    while n - start > CHUNK:
        cut = _BETWEEN.search(text, start + CHUNK)
        end = cut.end() if cut else n
        yield _found(text[start:end])
        start = end
    yield _found(text[start:])


def parts_of(word: str) -> list[str]:
    """A word with the mark in front; a long one in parts."""
    if len(word) <= LONGEST_WORD:
        return [MARK + word]
    return [MARK + word[k : k + LONGEST_WORD] for k in range(0, len(word), LONGEST_WORD)]


class Trie:
    """The pieces as a trie whose steps are looked up for many places at once."""

    SLOTS = 18  # bits of each of the tables of steps

    def __init__(self, pieces: list[str]):
        node = {"": 0}
        for p in pieces:
            for k in range(1, len(p) + 1):
                node.setdefault(p[:k], len(node))
        letters = {c: k for k, c in enumerate(sorted({c for p in pieces for c in p}), 1)}
        self.letter = np.zeros(0x110000, np.int32)
        for c, k in letters.items():
            self.letter[ord(c)] = k
        self.width = len(letters) + 1
        self.piece = np.zeros(len(node), np.int32)
        for k, p in enumerate(pieces, 1):
            self.piece[node[p]] = k
        names = [x for x in node if x]
        keys = np.array([node[x[:-1]] * self.width + letters[x[-1]] for x in names], np.int64)
        child = np.array([node[x] for x in names], np.int32)
        # steps that share a slot of a table go on to the next table
        self.tables = []
        while len(keys):
            at = self._slot(keys, len(self.tables))
            _, first = np.unique(at, return_index=True)
            held, to = np.full(1 << self.SLOTS, -1, np.int64), np.zeros(1 << self.SLOTS, np.int32)
            held[at[first]], to[at[first]] = keys[first], child[first]
            self.tables.append((held, to))
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, child = keys[rest], child[rest]

    def _slot(self, keys: np.ndarray, table: int) -> np.ndarray:
        odd = np.uint64(0x9E3779B97F4A7C15 + 2 * table * 0x632BE59BD9B4E019 & (1 << 64) - 1)
        return (keys.astype(np.uint64) * odd >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def step(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The child of each node by each letter, or -1."""
        keys = node.astype(np.int64) * self.width + letter
        out = np.full(len(keys), -1, np.int32)
        for k, (held, to) in enumerate(self.tables):
            at = self._slot(keys, k)
            out = np.where(held[at] == keys, to[at], out)
        return out


class Lattices:
    """All segmentations of a list of words, as arcs (word, start, end, piece) between places of the words.

    A character that is no piece has an arc of piece -1.
    """

    def __init__(self, trie: Trie, words: list[str]):
        letter = trie.letter[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]
        self.sizes = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(self.sizes) - self.sizes
        word = np.repeat(np.arange(len(words)), self.sizes)
        start = np.arange(len(letter)) - first[word]
        left = self.sizes[word] - start
        place, node, arcs = np.arange(len(letter)), np.zeros(len(letter), np.int32), []
        for length in range(1, LONGEST + 1):
            some = left[place] >= length
            place, node = place[some], node[some]
            if not len(place):
                break
            node = trie.step(node, letter[place + length - 1])
            piece = np.where(node >= 0, trie.piece[node], 0) - 1
            there = (piece >= 0) | (length == 1)
            arcs.append((place[there], np.full(there.sum(), length), piece[there]))
            place, node = place[node >= 0], node[node >= 0]
        at, length, self.piece = (np.concatenate([a[k] for a in arcs]) for k in range(3)) if arcs else [np.empty(0, np.int64)] * 3
        self.word, self.start = word[at], start[at]
        self.end = self.start + length

    def _swept(self, by: np.ndarray, places):
        order = np.argsort(by * len(self.sizes) + self.word)
        cuts = np.searchsorted(by[order], np.arange(LONGEST_WORD + 4))
        for place in places:
            own = order[cuts[place] : cuts[place + 1]]  # by word
            if len(own):
                yield place, own, np.flatnonzero(np.r_[True, np.diff(self.word[own]) > 0])

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sum over the segmentations of each prefix; ``weight``: a row for each arc, a column for each language."""
        a = np.zeros((len(self.sizes), LONGEST_WORD + 2, weight.shape[1]))
        a[:, 0] = 1
        for end, own, firsts in self._swept(self.end, range(1, LONGEST_WORD + 2)):
            w = self.word[own]
            a[w[firsts], end] = np.add.reduceat(a[w, self.start[own]] * weight[own], firsts)
        return a

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """The same for each suffix."""
        b = np.zeros((len(self.sizes), LONGEST_WORD + 2, weight.shape[1]))
        b[np.arange(len(self.sizes)), self.sizes] = 1
        for start, own, firsts in self._swept(self.start, range(LONGEST_WORD + 1, -1, -1)):
            w = self.word[own]
            b[w[firsts], start] = np.add.reduceat(b[w, self.end[own]] * weight[own], firsts)
        return b

    def totals(self, weight: np.ndarray) -> np.ndarray:
        return self.forward(weight)[np.arange(len(self.sizes)), self.sizes]

    def expected(self, weight: np.ndarray) -> np.ndarray:
        """Expected uses of each arc (weights of one language), over the segmentations of its word."""
        a, b = self.forward(weight)[:, :, 0], self.backward(weight)[:, :, 0]
        return a[self.word, self.start] * weight[:, 0] * b[self.word, self.end] / b[self.word, 0]


def word_counts(docs: DataFrame, fold: Column) -> DataFrame:
    """(lang, word, n) over all learning documents; a row with a null word counts the documents."""
    small_batches(docs.sparkSession)
    rows = docs.where(~fold & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))

    def run(batches):
        held: dict[str, Counter] = {}

        def counted():
            rows = [(lang, p, n) for lang, own in held.items() for w, n in own.items() for p in (parts_of(w) if w else [None])]
            cols = list(zip(*rows, strict=True))
            kinds = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["lang", "word", "n"])

        for b in slices(batches):
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = held.setdefault(lang, Counter())
                own[""] += 1
                for words in words_of(text):
                    own.update(words)
            if sum(map(len, held.values())) > 200_000:
                yield counted()
                held = {}
        if held:
            yield counted()

    counts = rows.mapInArrow(run, "lang string, word string, n bigint")
    return kept_table(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


class Models:
    """Piece probabilities (pieces x languages; last row: a character without a piece) and the documents' shares."""

    def __init__(self, languages: list[str], pieces: list[str], documents: np.ndarray):
        self.languages, self.pieces = languages, pieces
        self.prior = np.log(documents / documents.sum())
        self.probability = np.full((len(pieces) + 1, len(languages)), 1 / len(pieces))
        self.probability[-1] = np.exp(UNKNOWN)


def fit_languages(docs: DataFrame, path: str, fold: Column) -> Models | None:
    """Models of all languages of the learning documents, or None if there are none."""
    spark = docs.sparkSession
    counts = word_counts(docs, fold)
    langs = counts.where("word is null").orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not langs:
        return None
    pieces = pieces_of(path)
    models = Models([r["lang"] for r in langs], pieces, np.array([float(r["n"]) for r in langs]))
    column = {x: k for k, x in enumerate(models.languages)}
    words = counts.where("word is not null")
    for _ in range(ROUNDS):
        held = spark.sparkContext.broadcast((pieces, models.probability))

        def run(batches, held=held):
            pieces, probability = held.value
            trie = Trie(pieces)
            sums = np.zeros(probability.size)
            for b in batches:
                if not b.num_rows:
                    continue
                lattices = Lattices(trie, b.column(1).to_pylist())
                lang = np.array([column[x] for x in b.column(0).to_pylist()])[lattices.word]
                used = lattices.expected(probability[lattices.piece, lang][:, None])
                times = b.column(2).to_numpy()[lattices.word]
                place = np.where(lattices.piece < 0, len(pieces), lattices.piece) * probability.shape[1] + lang
                sums += np.bincount(place, used * times, probability.size)
            sums = sums.reshape(probability.shape)
            piece, lang = np.nonzero(sums)
            cols = [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(sums[piece, lang], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, names=["piece", "lang", "v"])

        parts = words.select("lang", "word", "n").mapInArrow(run, "piece int, lang int, v double")
        got = parts.groupBy("piece", "lang").agg(F.sum("v").alias("v")).toArrow()  # at most pieces x languages
        sums = np.full(models.probability.shape, SMOOTHING)
        sums[got.column("piece").to_numpy(), got.column("lang").to_numpy()] += got.column("v").to_numpy()
        models.probability[:-1] = sums[:-1] / sums[:-1].sum(axis=0)
        held.unpersist()
    return models


class Scorer:
    """Posterior of the languages of whole texts; remembers the words of CACHED places."""

    def __init__(self, models: Models):
        self.models = models
        self.trie = Trie(models.pieces)
        self.known: dict[str, int] = {}
        self.logs = np.zeros((CACHED, len(models.languages)))

    def _learn(self, words: list[str]) -> None:
        """Log probabilities of the words that are not known yet."""
        new = [w for w in dict.fromkeys(words) if w not in self.known]
        if len(self.known) + len(new) > len(self.logs):
            self.known, new = {}, list(dict.fromkeys(words))
            if len(new) > len(self.logs):
                self.logs = np.zeros((len(new), self.logs.shape[1]))
        for k in range(0, len(new), 2000):
            some = new[k : k + 2000]
            sizes = np.array([-(-len(w) // LONGEST_WORD) for w in some])
            parts = [p for w in some for p in parts_of(w)] if sizes.max() > 1 else [MARK + w for w in some]
            lattices = Lattices(self.trie, parts)
            totals = np.log(lattices.totals(self.models.probability[lattices.piece]))
            at = len(self.known)
            self.logs[at : at + len(some)] = np.add.reduceat(totals, np.cumsum(sizes) - sizes)
            self.known.update(zip(some, range(at, at + len(some)), strict=True))

    def _sums(self, lists: list[list[str]]) -> np.ndarray:
        """Summed log probabilities of each list's words."""
        words = [w for own in lists for w in own]
        self._learn(words)
        sizes = np.array([len(own) for own in lists], np.int64)
        out = np.zeros((len(lists), self.logs.shape[1]))
        some = np.flatnonzero(sizes)
        if len(some):
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            out[some] = np.add.reduceat(self.logs[at], (np.cumsum(sizes) - sizes)[some])
        return out

    def score(self, texts: list[str]) -> list[tuple[str, float]]:
        split = [list(words_of(t)) for t in texts]
        lists, owner = [w for words in split for w in words], np.repeat(np.arange(len(texts)), [len(words) for words in split])
        totals = np.tile(self.models.prior, (len(texts), 1))
        # lists go together up to as many words as the cache has places
        ends = np.cumsum([len(w) for w in lists])
        start = 0
        while start < len(lists):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + CACHED, "right")))
            np.add.at(totals, owner[start:stop], self._sums(lists[start:stop]))
            start = stop
        rounded = np.argmax(np.round(totals, 9), axis=1)
        odds = np.exp(totals - totals.max(axis=1, keepdims=True))
        scores = odds[np.arange(len(texts)), rounded] / odds.sum(axis=1)
        return [
            (self.models.languages[best], score) if any(words) else ("und", 0.0)
            for words, best, score in zip(split, rounded.tolist(), scores.tolist(), strict=True)
        ]


def score_languages(docs: DataFrame, models: Models | None, columns: list) -> DataFrame:
    """``columns`` of every row with lang_pred and score (posterior of that language)."""
    held = docs.sparkSession.sparkContext.broadcast(models)

    def make():
        if held.value is None:
            return lambda texts: [("und", 0.0)] * len(texts)
        return Scorer(held.value).score

    return map_texts(docs, make, "lang_pred string, score double", columns, many=True)


def identify(docs: DataFrame, path: str) -> DataFrame:
    fold = learn_fold("doc_id", 4, 2)
    with temporary_tables(docs.sparkSession):
        models = fit_languages(docs, path, fold)
    return score_languages(docs, models, ["doc_id", fold.alias("held_out")])
