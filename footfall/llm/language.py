"""Language of words and documents by a linear-chain conditional random field.

Each word of a sentence gets a language. A word's score for a language adds the weights of its
features: character bigrams and trigrams with the word's ends, affixes of up to four characters,
the word itself, and the lexicons of frequent words it is in. Learned transitions say how likely
the language changes from one word to the next, so a sentence may switch. Forward-backward gives
each word's probabilities; a document has the language with the largest sum, and its score is
that language's share.

A score says which learned language fits best, not whether one does. For that, a word is known as
far as its trigrams occur in words that its language was learned from, and a document as far as
its words are on average, each in the languages it may have. This does not depend on how many
languages there are, and a text that switches between learned ones is known.

Fitting sees at most ``max_docs`` documents, as many of each language as there are, in the order
of a hash of the id, and of each some sentences spread over the whole text; the bounds
are parameters of ``fit``. Some training sentences are joined with one of another document, so that
changes of language are seen. Labelling reads every whole text.

A sentence ends at ``.``, ``!``, ``?`` or a line's end, however many words it has: a long
one is worked on in parts that hand over their forward and backward messages, with the result of the
whole. Defined cases: a text that is null or has no letter is ``und`` with
score 0, and so is every text if there is nothing to learn from; repeated rows get the same
result; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import free_names, is_held_out

TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = ".!?\n"
#: Longer chains are worked on in parts that hand over their messages.
CHAIN = 256
BUCKETS = 1 << 18
AFFIXES = (2, 3, 4)
TRIGRAMS = 1  # their place among the families of features
#: Characters of text that are labelled at a time; a longer text is one by itself.
PART_CHARS = 1 << 19
#: Bytes that a worker's scores of words may take.
HELD_BYTES = 32 << 20
UNKNOWN = "und"
LEAST_KNOWN = 0.8
MIX = np.uint64(0x9E3779B97F4A7C15)


def bucket(tag: int, *codes: np.ndarray) -> np.ndarray:
    """A feature's number from its kind and the characters it is made of."""
    h = np.full(len(codes[0]), tag, np.uint64)
    for code in codes:
        h = (h ^ code.astype(np.uint64)) * MIX
        h ^= h >> np.uint64(31)
    return (h % np.uint64(BUCKETS)).astype(np.int64)


def word_features(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(features, first of each word): families of features, in the order of the words."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    begin = np.cumsum(lengths) - lengths
    last = begin + lengths - 1
    families = []
    for n in (2, 3):
        here = np.ones(len(codes), bool)
        for k in range(n - 1):
            here[last - k] = False
        at = np.flatnonzero(here)
        counts = lengths - n + 1
        families.append((bucket(n, *(codes[at + k] for k in range(n))), np.cumsum(counts) - counts))
    one = np.arange(len(words))
    for n in AFFIXES:
        head = [codes[np.minimum(begin + k, last)] for k in range(n + 1)]
        tail = [codes[np.maximum(last - k, begin)] for k in range(n + 1)]
        families += [(bucket(10 + n, *head), one), (bucket(20 + n, *tail), one)]
    whole = codes.astype(np.uint64) + np.uint64(1)
    whole = whole * MIX ** (np.arange(len(codes)) - np.repeat(begin, lengths)).astype(np.uint64)
    families.append((bucket(30, np.add.reduceat(whole, begin)), one))
    return families


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # bucket, language
    lexicons: dict[str, int]  # word: one bit per language
    lexicon_weights: np.ndarray  # lexicon, language
    start: np.ndarray
    change: np.ndarray  # from language, to language
    seen: np.ndarray  # bucket, language: trigrams of the words learned from

    def emissions(self, words: list[str], families: list | None = None) -> np.ndarray:
        total = np.zeros((len(words), len(self.languages)))
        for features, first in families or word_features(words):
            total += np.add.reduceat(self.weights[features], first, axis=0)
        return total + self.in_lexicons(words) @ self.lexicon_weights

    def known(self, families: list) -> np.ndarray:
        """The share of each word's trigrams that each language's words have."""
        features, first = families[TRIGRAMS]
        counts = np.diff(np.append(first, len(features)))
        return np.add.reduceat(self.seen[features], first, axis=0, dtype=float) / counts[:, None]

    def in_lexicons(self, words: list[str]) -> np.ndarray:
        bits = np.fromiter(map(self.lexicons.get, words, repeat(0)), np.int64, len(words))
        return (bits[:, None] >> np.arange(len(self.languages)) & 1).astype(float)


def forward_backward(
    score: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray, change: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Probabilities of each position's labels, expected changes, and the log of all chains' sums.

    Chain i has the ``size[i]`` positions from ``begin[i]``. All chains take a step at a time, longest first.
    """
    n, k = score.shape
    top = score.max(axis=1, keepdims=True)
    local = np.exp(score - top)
    first, step = np.exp(start), np.exp(change)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")  # chains with more than t positions
    ahead, norm = np.empty((n, k)), np.empty((n, 1))
    for t in range(longest):
        at = begin[: active[t]] + t
        a = (first if t == 0 else ahead[at - 1] @ step) * local[at]
        norm[at] = a.sum(axis=1, keepdims=True)
        ahead[at] = a / norm[at]
    behind, expected = np.ones((n, k)), np.zeros((k, k))
    for t in range(longest - 1, 0, -1):
        at = begin[: active[t]] + t
        b = local[at] * behind[at] / norm[at]
        behind[at - 1] = b @ step.T
        expected += ahead[at - 1].T @ b
    return ahead * behind, expected * step, float(np.log(norm).sum() + top.sum())


def ahead_of(local: np.ndarray, begin: np.ndarray, size: np.ndarray, enter: np.ndarray, step: np.ndarray) -> np.ndarray:
    """What rows of weights that enter a part become at its last position, scaled by their sum.

    ``enter`` has some rows of weights per part, before the first position's own.
    """
    order = np.argsort(-size, kind="stable")
    begin, size, found = begin[order], size[order], enter[order]
    for t in range(int(size[0]) if len(size) else 0):
        active = np.searchsorted(-size, -t, side="left")
        now = (found[:active] if t == 0 else found[:active] @ step) * local[begin[:active] + t][:, None, :]
        found[:active] = now / now.sum(axis=(1, 2), keepdims=True)
    result = np.empty_like(found)
    result[order] = found
    return result


def posterior(score: np.ndarray, begin: np.ndarray, start: np.ndarray, change: np.ndarray, part: int) -> np.ndarray:
    """Probabilities of each position's labels for chains that begin at ``begin``, of any length.

    Long chains are cut into parts of ``part`` positions. What one part hands to the next, in both
    directions, follows from how each label before a part weighs on its last position; with these
    messages all parts take their steps together.
    """
    n, k = score.shape
    local = np.exp(score - score.max(axis=1, keepdims=True))
    first, step = np.exp(start), np.exp(change)
    chain = np.diff(np.append(begin, n))
    parts = -(-chain // part)
    opens = np.cumsum(parts) - parts  # the first part of each chain
    goes_on = np.ones(parts.sum(), bool)
    goes_on[opens] = False
    place = np.arange(len(goes_on)) - np.repeat(opens, parts)
    at = np.repeat(begin, parts) + place * part
    size = np.minimum(part, np.repeat(begin + chain, parts) - at)

    enter = np.where(goes_on[:, None], 0.0, first)
    leave = np.ones((len(at), k))
    several = np.flatnonzero(np.repeat(parts > 1, parts))
    if len(several):
        rows = np.where(goes_on[several][:, None, None], step, np.broadcast_to(first, (k, k)))
        through = np.zeros((len(at), k, k))
        through[several] = ahead_of(local, at[several], size[several], rows, step)
        for depth in range(1, int(parts.max())):  # one part further in every long chain
            here = opens[parts > depth] + depth
            if depth == 1:
                message = through[here - 1][:, 0]
            else:
                message = np.einsum("ci,cij->cj", message[parts[alive] > depth], through[here - 1])
            alive = np.flatnonzero(parts > depth)
            message = message / message.sum(axis=1, keepdims=True)
            enter[here] = message @ step
        for depth in range(int(parts.max()) - 2, -1, -1):
            here = opens[parts > depth + 1] + depth
            back = np.einsum("cij,cj->ci", through[here + 1], leave[here + 1])
            leave[here] = back / back.sum(axis=1, keepdims=True)

    order = np.argsort(-size, kind="stable")
    at, size, enter, leave = at[order], size[order], enter[order], leave[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(longest), side="left")
    ahead, norm, behind = np.empty((n, k)), np.empty((n, 1)), np.ones((n, k))
    for t in range(longest):
        now = at[: active[t]] + t
        a = (enter if t == 0 else ahead[now - 1] @ step) * local[now]
        norm[now] = a.sum(axis=1, keepdims=True)
        ahead[now] = a / norm[now]
    behind[at + size - 1] = leave
    for t in range(longest - 1, 0, -1):
        now = at[: active[t]] + t
        behind[now - 1] = (local[now] * behind[now] / norm[now]) @ step.T
    found = ahead * behind
    return found / found.sum(axis=1, keepdims=True)


def train(sentences: list[tuple[str, list[str]]], rounds: int = 30, rate: float = 0.4, ridge: float = 1e-4) -> Model:
    """Weights that maximise the chains' likelihood, by gradient steps scaled per weight."""
    languages = sorted({language for language, _ in sentences})
    number = {language: i for i, language in enumerate(languages)}
    rng = np.random.default_rng(7)
    chains = [([number[language]] * len(words), list(words)) for language, words in sentences if words]
    others = rng.permutation(len(chains))
    for i in np.flatnonzero(rng.random(len(chains)) < 0.2):
        labels, words = chains[others[i]]
        chains[i] = (chains[i][0] + labels, chains[i][1] + words)
    distinct = {word: i for i, word in enumerate(dict.fromkeys(w for _, words in chains for w in words))}
    seen: list[Counter] = [Counter() for _ in languages]
    for language, words in sentences:
        seen[number[language]].update(words)
    lexicons: dict[str, int] = {}
    for i, counter in enumerate(seen):
        for word, count in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:1000]:
            if count > 1:
                lexicons[word] = lexicons.get(word, 0) | 1 << i
    k = len(languages)
    weights, lexicon_weights = np.zeros((BUCKETS, k)), np.zeros((k, k))
    start, change = np.zeros(k), np.zeros((k, k))
    trigrams = np.zeros((BUCKETS, k), bool)
    for i, counter in enumerate(seen):
        if counter:
            trigrams[word_features(list(counter))[TRIGRAMS][0], i] = True
    model = Model(languages, weights, lexicons, lexicon_weights, start, change, trigrams)
    if not chains:
        return model
    words = list(distinct)
    families = word_features(words)
    known = model.in_lexicons(words)
    owners = [np.repeat(np.arange(len(words)), np.diff(np.append(first, len(f)))) for f, first in families]
    features, owners = np.concatenate([f for f, _ in families]), np.concatenate(owners)
    position = np.fromiter((distinct[w] for _, ws in chains for w in ws), np.int64)
    label = np.fromiter((x for labels, _ in chains for x in labels), np.int64)
    size = np.array([len(ws) for _, ws in chains])
    begin = np.cumsum(size) - size
    truth = np.eye(k)[label]
    inside = np.ones(len(label), bool)
    inside[begin] = False
    at = np.flatnonzero(inside)
    true_change = np.zeros((k, k))
    np.add.at(true_change, (label[at - 1], label[at]), 1)
    sums = [np.full_like(x, 1e-8) for x in (weights, lexicon_weights, start, change)]
    total = len(label)
    for _ in range(rounds):
        score = model.emissions(words)[position]
        found, expected, _ = forward_backward(score, begin, size, start, change)
        error = truth - found
        by_word = np.stack([np.bincount(position, error[:, j], len(words)) for j in range(k)], axis=1)
        by_feature = np.stack([np.bincount(features, by_word[owners, j], BUCKETS) for j in range(k)], axis=1)
        gradients = (by_feature, known.T @ by_word, error[begin].sum(axis=0), true_change - expected)
        for value, gradient, squares in zip((weights, lexicon_weights, start, change), gradients, sums):
            gradient = gradient / total - ridge * value
            squares += gradient**2
            value += rate * gradient / np.sqrt(squares)
    return model


def sentences_of(text: str | None) -> list[list[str]]:
    """The words of each sentence, in lower case."""
    found, sentence = [], []
    for token in TOKENS.findall((text or "").lower()):
        if token in ENDS:
            found.append(sentence)
            sentence = []
        elif any(map(str.isalpha, token)):
            sentence.append(token)
    return [s for s in (*found, sentence) if s]


def fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    max_docs: int = 1500,
    sentences: int = 10,
    sentence_words: int = 32,
) -> Model:
    """Learn from up to ``max_docs`` documents with a language that are not held out.

    Of each take up to ``sentences`` sentences, spread over the text, and of these the first
    ``sentence_words`` words. The bounds hold for the learning alone; labelling reads whole texts.
    """
    known = docs.select(F.col(doc_id).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    known = known.filter(F.col("lang").isNotNull() & F.col("id").isNotNull() & ~is_held_out("id"))
    in_turn = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (
        known.select("id", "lang")
        .distinct()
        .withColumn("turn", F.row_number().over(in_turn))
        .filter(F.col("turn") <= max_docs)
        .orderBy("turn", "lang")
        .limit(max_docs)
        .select("id", "lang")
    )

    @F.pandas_udf("array<array<string>>")
    def some_sentences(texts: pd.Series) -> pd.Series:
        result = []
        for value in texts:
            all_of_them = sentences_of(value)
            spread = np.unique(np.linspace(0, len(all_of_them) - 1, min(sentences, len(all_of_them))).astype(int))
            result.append([all_of_them[i][:sentence_words] for i in spread])
        return pd.Series(result)

    # the sample has at most max_docs short rows, so it can go to every task; rows that repeat an id count once
    rows = (
        known.join(F.broadcast(chosen), ["id", "lang"])
        .groupBy("id", "lang")
        .agg(F.min(some_sentences("text")).alias("sentences"))
        .orderBy(F.xxhash64("id"), "id", "lang")
        .limit(max_docs)
        .collect()
    )
    return train([(row.lang, words) for row in rows for words in row.sentences])


def grown(table: np.ndarray, most: int) -> np.ndarray:
    """The table with room for ``most`` rows, and a quarter more."""
    larger = np.empty((most + most // 4, table.shape[1]), table.dtype)
    larger[: len(table)] = table
    return larger


class Labeller:
    """Labels the words of texts; a worker scores a word when it first meets it, and holds about ``capacity`` of them."""

    def __init__(self, model: Model, capacity: int = 200_000):
        each = 12 * max(1, len(model.languages))  # a score and a share for each language
        self.model, self.capacity = model, min(capacity, HELD_BYTES // each)
        self.forget()

    def forget(self) -> None:
        # 0 is a sentence's end, 1 a word without a letter
        self.slots: dict[str, int] = dict.fromkeys(ENDS, 0)
        self.used = 2
        self.scores = np.zeros((1 << 12, len(self.model.languages)))
        self.known = np.zeros((1 << 12, len(self.model.languages)), np.float32)

    def numbers(self, tokens: list[str]) -> np.ndarray:
        if len(self.slots) > self.capacity:
            self.forget()
        found = list(map(self.slots.get, tokens))
        new = [i for i, slot in enumerate(found) if slot is None]
        if new:
            words = list(dict.fromkeys(tokens[i] for i in new))
            real = [w for w in words if any(map(str.isalpha, w))]
            self.slots.update(zip(words, repeat(1)))
            if real:
                most = self.used + len(real)
                if most > len(self.scores):
                    self.scores, self.known = grown(self.scores, most), grown(self.known, most)
                families = word_features(real)
                self.scores[self.used : most] = self.model.emissions(real, families)
                self.known[self.used : most] = self.model.known(families)
                self.slots.update(zip(real, range(self.used, most)))
                self.used = most
            for i in new:
                found[i] = self.slots[tokens[i]]
        return np.array(found, np.int64)

    def probabilities(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of the text of each word, and the word's probability of each language."""
        text, found, _ = self.words(texts)
        return text, found

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``probabilities`` gives, and how far each word is known."""
        tokens = [TOKENS.findall(text.lower()) for text in texts]
        slot = self.numbers([token for own in tokens for token in own])
        text = np.repeat(np.arange(len(texts)), [len(own) for own in tokens])
        part = np.cumsum(slot == 0)
        word = slot > 1
        slot, text, part = slot[word], text[word], part[word]
        if not len(slot):
            return text, np.zeros((0, len(self.model.languages))), np.zeros(0)
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (text[1:] != text[:-1])])
        found = posterior(self.scores[slot], np.flatnonzero(new), self.model.start, self.model.change, CHAIN)
        return text, found, (found * self.known[slot]).sum(axis=1)

    def languages(self, texts: list[str]) -> list[tuple[str, float]]:
        return [(name, score) for name, score, _ in self.labels(texts)]

    def labels(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """The language of each text, its score, and how far the text is known."""
        names, result = self.model.languages, []
        if not names:
            return [(UNKNOWN, 0.0, 0.0)] * len(texts)
        begin = size = 0
        for i in range(len(texts) + 1):
            if i == len(texts) or size and size + len(texts[i]) > PART_CHARS:
                text, found, known = self.words(texts[begin:i])
                sums = np.stack([np.bincount(text, found[:, j], i - begin) for j in range(len(names))], axis=1)
                known = np.bincount(text, known, i - begin).tolist()
                words, best = np.bincount(text, minlength=i - begin), sums.argmax(axis=1)
                for n, j, own, k in zip(words.tolist(), best.tolist(), sums, known):
                    result.append((names[j], min(1.0, float(own[j] / n)), min(1.0, k / n)) if n else (UNKNOWN, 0.0, 0.0))
                begin, size = i, 0
            if i < len(texts):
                size += len(texts[i])
        return result


def with_language(
    docs: DataFrame, model: Model, language: str, score: str, text: str = "text", known: str | None = None
) -> DataFrame:
    """``docs`` with the language of each whole text, its score and, if named, how far it is known; only the text goes to Python."""
    (both,) = free_names(docs, "language_and_score")

    @F.pandas_udf("lang string, score double, known double")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model)
        for texts in batches:
            yield pd.DataFrame(labeller.labels([t or "" for t in texts]), columns=["lang", "score", "known"])

    docs = docs.withColumn(both, label(F.col(text)))
    columns = {language: F.col(f"{both}.lang"), score: F.col(f"{both}.score")}
    return docs.withColumns(columns | ({known: F.col(f"{both}.known")} if known else {})).drop(both)


def accepted(
    docs: DataFrame, model: Model, text: str = "text", least: float = 0.35, least_known: float = LEAST_KNOWN
) -> DataFrame:
    """The rows of ``docs`` whose text is in a learned language with a score of at least ``least``.

    A text in two languages has a score of about a half, so it stays. One that is known by less than
    ``least_known`` is in none of them.
    """
    names = language, score, known = free_names(docs, "lang_pred", "lang_score", "lang_known")
    labelled = with_language(docs, model, language, score, text, known)
    stays = (F.col(language) != UNKNOWN) & (F.col(score) >= least) & (F.col(known) >= least_known)
    return labelled.filter(stays).drop(*names)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    labelled = with_language(docs.select("doc_id", "text"), fit(docs), "lang_pred", "score")
    return labelled.select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score")
