"""Exact encoding with public tokenizers, inside tasks.

For tokenizers that drop white space, no token and no normalisation reaches over an ASCII blank,
so a text's ids are those of its runs between blanks, one after the other. A worker encodes a
run when it first meets it and looks it up after that; of columns that are read once, it encodes
the distinct runs of a part together and keeps none of them.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes of text that are split into runs at a time.
PART_BYTES = 2 << 20
#: Bytes of a column whose distinct runs are encoded once and then let go.
COLUMN_BYTES = 16 << 20


def word_tokenizer() -> str:
    """Where the public tokenizer of the registered queries is; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Between runs that are encoded together; a run that holds it is encoded by itself.
BETWEEN = "\x01"
#: May stand behind a word, if the tokenizer always parts them from letters.
POINTS = b".,;:!?*#$%&+=~/)]}\"-"
#: So many runs are encoded as one text.
TOGETHER = 512


class RunEncoder:
    """ids of whole texts, given as UTF-8; at most about ``capacity`` runs are held."""

    def __init__(self, path: str, capacity: int = 1_000_000):
        self.tokenizer = load(path)
        parts = [self.ids_of(t) for t in (" ab\n\tcd ", "ab", "cd")]
        if parts[0] != parts[1] + parts[2]:
            raise ValueError(f"{path} does not drop white space")
        self.folds = self.ids_of("ABcD") == self.ids_of("abcd")  # letter case makes no difference
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.between = self.ids_of(BETWEEN)
        self.capacity = capacity
        self.forget()
        self.find_letters()
        self.forget()

    def find_letters(self) -> None:
        """Lower-case letters of Latin-1 that the tokenizer keeps together and turns into fixed characters.

        Words of these go to the model directly. If that and the tokenizer differ on any probe, no
        word does. Points are those that the tokenizer parts from the letters before them.
        """
        from tokenizers import Tokenizer, pre_tokenizers

        prepare, normal = self.tokenizer.pre_tokenizer, self.tokenizer.normalizer

        def prepared(text: str) -> list[str]:
            return [part for part, _ in prepare.pre_tokenize_str(normal.normalize_str(text))] if prepare and normal else []

        self.letters: dict[int, str] = {}
        for letter in map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]):
            found = prepared(f"ab{letter}cd")
            if len(found) == 1 and found[0].startswith("ab") and found[0].endswith("cd"):
                self.letters[ord(letter)] = found[0][2:-2]
        self.points = bytes(point for point in POINTS if prepared(f"ab{chr(point)}")[:1] == ["ab"])
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        every = "".join(map(chr, self.letters))
        self.is_word = re.compile(f"[{every}]+" if every else "(?!)").fullmatch
        tried = ["the", "ab.", "qzxw,", "antidisestablishmentarianism.,,", "s", "t.", "re,", "x" * 300, every, every + "."]
        tried = [word for word in tried if word] + [f"ab{chr(point)}" for point in POINTS]
        differs = any(ids.tolist() != self.ids_of(word) for word, ids in zip(tried, self.encode([w.encode() for w in tried])))
        if differs or not {*range(0x61, 0x7B)} <= {*self.letters}:
            self.letters, self.is_word = {}, re.compile("(?!)").fullmatch

    def ids_of(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def forget(self) -> None:
        self.slots: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.used = 0

    def runs_of(self, text: bytes) -> list[bytes]:
        """A text's runs; without letter case, unless that might make a special token of something."""
        if self.folds:
            low = text.lower()
            if not any(token in low for token in self.special):
                return low.split()
        return text.split()

    def together(self, group: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of runs that do not hold ``BETWEEN``, and how many each has."""
        runs = [run.decode() for run in group]
        whole = np.array(self.ids_of(f" {BETWEEN} ".join(runs)), np.uint32)
        if len(self.between) == 1:
            marks = np.flatnonzero(whole == self.between[0])
            if len(marks) == len(runs) - 1:
                lengths = np.diff(np.concatenate([[-1], marks, [len(whole)]])) - 1
                return np.delete(whole, marks), lengths
        each = [self.ids_of(run) for run in runs]
        return np.array([i for ids in each for i in ids], np.uint32), np.array([len(ids) for ids in each], np.int64)

    def model_ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of words of letters in ``letters``, and how many each has."""
        found = self.model.encode(b" ".join(words).decode().translate(self.letters), add_special_tokens=False)
        return np.array(found.ids, np.uint32), np.bincount(np.array(found.word_ids, np.int64), minlength=len(words))

    def learn(self, runs: list[bytes]) -> None:
        """Takes up runs that are not held; of a word with points behind it, the word and the points too."""
        words, others, by_itself, pointed = {}, {}, [], []
        for run in runs:
            stem = run.rstrip(self.points)
            if not self.is_word(stem.decode()):
                if BETWEEN.encode() in run:
                    by_itself.append(run)
                else:
                    others[run] = None
                continue
            if stem not in self.slots:
                words[stem] = None
            if len(stem) < len(run):
                tail = run[len(stem) :]
                pointed.append((run, stem, tail))
                if tail not in self.slots:
                    others[tail] = None
        for run in by_itself:
            ids = self.ids_of(run.decode())
            self.add([run], np.array(ids, np.uint32), np.array([len(ids)]))
        for new, ids_of in ((list(words), self.model_ids), (list(others), self.together)):
            for i in range(0, len(new), TOGETHER):
                self.add(new[i : i + TOGETHER], *ids_of(new[i : i + TOGETHER]))
        if pointed:
            halves = [self.slots[half] for _, *both in pointed for half in both]
            ids, lengths = self.held(np.array(halves, np.int64))
            self.add([run for run, _, _ in pointed], ids, lengths[::2] + lengths[1::2])

    def add(self, runs: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.slots)
        need, most = self.used + len(ids), first + len(runs)
        if need > len(self.flat):
            self.flat = np.resize(self.flat, 2 * need)
        if most > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * most), np.resize(self.length, 2 * most)
        self.flat[self.used : need] = ids
        self.start[first:most] = self.used + np.cumsum(lengths) - lengths
        self.length[first:most] = lengths
        self.slots.update(zip(runs, range(first, most)))
        self.used = need

    def run_ids(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all runs, and how many each run has."""
        if len(self.slots) > self.capacity:
            self.forget()
        slot = np.fromiter(map(self.slots.get, runs, repeat(-1)), np.int64, len(runs))
        new = np.flatnonzero(slot < 0)
        if len(new):
            unknown = [runs[i] for i in new.tolist()]
            self.learn(list(dict.fromkeys(unknown)))
            slot[new] = [self.slots[run] for run in unknown]
        return self.held(slot)

    def held(self, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return gathered(self.flat, self.start, self.length, slot)

    def with_runs(self, split: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each list of runs their ids, and how many each run has."""
        ids, lengths = self.run_ids([run for runs in split for run in runs])
        ends = np.cumsum([0, *map(len, split)])
        at = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
        ends = ends.tolist()
        for i in range(len(split)):
            yield ids[at[i] : at[i + 1]], lengths[ends[i] : ends[i + 1]]

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, as uint32."""
        return [ids for ids, _ in self.with_runs([self.runs_of(text) for text in texts])]

    def column_runs(self, texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Where the runs of each text begin and end, and the runs; letter case as in ``runs_of``."""
        if self.folds:
            low = pc.ascii_lower(texts)
            for token in self.special:
                low = pc.if_else(pc.match_substring(low, token.decode()), texts, low)
            texts = low
        split = pc.ascii_split_whitespace(texts)
        return np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy())]), split.flatten().dictionary_encode()

    def encode_column(self, column: pa.Array) -> Iterator[tuple[slice, list[np.ndarray]]]:
        """Slices of a column of strings, and the ids of each text there; nothing is held after that."""
        column = pc.fill_null(column, "")
        sizes = pc.binary_length(column).to_pylist()
        for whole in stretches(sizes, COLUMN_BYTES):
            ends, runs = self.column_runs(column[whole])
            slot = runs.indices.to_numpy()
            flat, length = self.ids_of_each(runs.dictionary)
            start = np.cumsum(length) - length
            for part in stretches(sizes[whole], PART_BYTES):
                own = ends[part.start : part.stop + 1]
                ids, lengths = gathered(flat, start, length, slot[own[0] : own[-1]])
                at = np.concatenate([[0], np.cumsum(lengths)])[own - own[0]].tolist()
                yield slice(whole.start + part.start, whole.start + part.stop), [ids[i:j] for i, j in zip(at, at[1:])]

    def ids_of_each(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids of distinct runs, and how many each has; a word with points behind it is the word and the points."""
        stems = pc.ascii_rtrim(runs, self.points.decode()) if self.points else runs
        is_word = np.zeros(len(runs), bool)
        if self.letters:
            is_word = pc.match_substring_regex(stems, f"\\A[{''.join(map(chr, self.letters))}]+\\z").to_numpy(False)
        by_itself = pc.match_substring(runs, BETWEEN).to_numpy(False)
        words = stems.filter(is_word).dictionary_encode()
        tails = tails_of(runs.filter(is_word), stems.filter(is_word)).dictionary_encode()
        plain = ~is_word & ~by_itself

        found = [
            *self.in_groups(words.dictionary, self.model_ids),
            *self.in_groups(tails.dictionary, self.together),
            *self.in_groups(runs.filter(plain), self.together),
            *self.in_groups(runs.filter(by_itself), self.together, 1),
            (np.empty(0, np.uint32), np.zeros(1, np.int64)),  # stands for no points
        ]
        flat, length = (np.concatenate(column) for column in zip(*found))
        halves = np.full((len(runs), 2), len(length) - 1)
        halves[is_word, 0] = words.indices.to_numpy()
        halves[is_word, 1] = len(words.dictionary) + tails.indices.to_numpy()
        first = len(words.dictionary) + len(tails.dictionary)
        halves[plain, 0] = first + np.arange(plain.sum())
        halves[by_itself, 0] = first + plain.sum() + np.arange(by_itself.sum())
        ids, lengths = gathered(flat, np.cumsum(length) - length, length, halves.ravel())
        return ids, lengths[::2] + lengths[1::2]

    def in_groups(self, runs: pa.Array, ids_of: Callable, size: int = TOGETHER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for i in range(0, len(runs), size):
            yield ids_of(utf8(runs[i : i + size]))


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``flat`` that slots stand for, one after the other, and how many each slot has."""
    lengths = length[slot]
    ends = np.cumsum(lengths)
    at = np.repeat(start[slot] - ends + lengths, lengths)
    at += np.arange(len(at))
    return flat[at], lengths


def tails_of(runs: pa.Array, stems: pa.Array) -> pa.Array:
    """What stands behind the stem that each run begins with."""
    runs = runs.cast(pa.large_binary())
    sizes = (pc.binary_length(runs).to_numpy() - pc.binary_length(stems).to_numpy()).astype(np.int64)
    ends = np.frombuffer(runs.buffers()[1], np.int64)[runs.offset + 1 : runs.offset + 1 + len(runs)]
    data = np.frombuffer(runs.buffers()[2] or b"", np.uint8)
    tails, _ = gathered(data, ends - sizes, sizes, np.arange(len(sizes)))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(tails)])


@lru_cache(maxsize=1)
def worker_encoder(path: str) -> RunEncoder:
    """The encoder of a Python worker, which it keeps from task to task."""
    return RunEncoder(path)


class Decoder:
    """What the tokenizer's ``decode`` gives with special tokens kept."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.names = None
        if tokenizer.decoder is None:  # then tokens are joined by blanks
            size = tokenizer.get_vocab_size(with_added_tokens=True)
            self.names = np.array([tokenizer.id_to_token(i) for i in range(size)], object)

    def decode(self, ids: np.ndarray) -> str:
        if self.names is None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        return " ".join(self.names[ids].tolist())


def utf8(column: pa.Array) -> list[bytes]:
    """A column of strings as UTF-8; null counts as empty."""
    return [value or b"" for value in column.cast(pa.large_binary()).to_pylist()]


def stretches(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive places of about ``most`` in sum; a larger one is one by itself."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def parts(texts: list[bytes]) -> Iterator[slice]:
    """Slices of consecutive texts of about ``PART_BYTES`` each; a longer text is one by itself."""
    return stretches([len(text) for text in texts], PART_BYTES)


PRESS, EXPAND = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(ids: np.ndarray) -> bytes:
    """ids compressed: a byte for the width, then the ids."""
    wide = len(ids) and int(ids.max()) >= 1 << 16
    return (b"4" if wide else b"2") + PRESS.compress(ids.astype("<u4" if wide else "<u2").tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    return np.frombuffer(EXPAND.decompress(blob[1:]), f"<u{blob[:1].decode()}").astype("<u4")
