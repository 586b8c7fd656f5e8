"""Packing and BPE against the tokenizers library over whole texts."""

import hashlib
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from footfall.llm import chunked_bpe, packing, tokens
from tests.conftest import SF_DIR

PATH = tokens.word_tokenizer()
DDL = "doc_id long, text string, source string, tokens string, `round` int"
ODD = [
    "", None, "   ", "größe naïveté, ÿþð ß. ÷ × ªº µm æœ über. Über, ñandú.,", "a\u0301b o\u0308 e\u0301.", "Straße ÀÉ\u0301 \u00a0x\u2003y \x1c\x1d z", "don't we'll I'M 'S", "a1b22 c3", "<|endoftext|> x<|startoftext|>y",
    "ΑΣ ΑΣΑ İI", "e\u0301 \u0301e", "<|EndOfText|> \x01 a\x01b UPPER", "漢字かな 한국 🙂🙂👩‍👩‍👧", "\u200bzero\ufeffwidth", "x" * 5000, "word " * 9000, "a\nb\r\nc\x0bd\x0ce",
]


def rows():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("aeioustrnl") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(60, 300))) for _ in range(6)]
    texts = list(ODD)
    for _ in range(60):
        own = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 200))) for _ in range(3)]
        texts.append(rng.choice(["", " ", "\n"]).join(own[:1] + [rng.choice(passages)] * rng.randint(0, 2) + own[1:]))
    texts += ["", "ab" * 4000] + texts[20:25] * 3 + ["x" * 5000]
    return [(i, t, rng.choice(["hot", "hot", "hot", "a", "b", None]), "n", i) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def library():
    return tokens.load(PATH)


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_runs_give_the_ids_of_whole_texts(library):
    texts = [t or "" for _, t, *_ in rows()]
    for capacity in (500_000, 5):
        encoder = tokens.RunEncoder(PATH, capacity)
        for _ in range(2):
            found = encoder.encode([t.encode() for t in texts])
            assert [x.tolist() for x in found] == [encoded(library, t) for t in texts]


class Counted:
    """Passes calls on and notes how many characters went to ``encode``."""

    def __init__(self, inner):
        self.inner, self.sizes = inner, []

    def __getattr__(self, name):
        return getattr(self.inner, name)

    def encode(self, text, **kwargs):
        self.sizes.append(len(text))
        return self.inner.encode(text, **kwargs)


def test_words_are_learned_together_and_once(library):
    rng = random.Random(6)
    words = list({"".join(rng.choice("aeioustrnlé") for _ in range(9)) for _ in range(3000)})
    runs = [word + tail for word in words for tail in ("", ".", ",", "!!", "***", '.")')]
    rng.shuffle(runs)
    encoder = tokens.RunEncoder(PATH)
    encoder.model, encoder.tokenizer = Counted(encoder.model), Counted(encoder.tokenizer)
    ids, lengths = encoder.run_ids([run.encode() for run in runs])
    ends = np.cumsum(lengths)
    for run, a, b in zip(runs, ends - lengths, ends):
        assert ids[a:b].tolist() == encoded(library, run)
    assert len(encoder.model.sizes) + len(encoder.tokenizer.sizes) < 10
    assert sum(encoder.model.sizes) + sum(encoder.tokenizer.sizes) < 2 * sum(map(len, words))


@pytest.mark.parametrize(("column_bytes", "part_bytes"), [(16 << 20, 2 << 20), (2000, 300), (1, 1)])
def test_columns_give_the_ids_of_whole_texts(library, monkeypatch, column_bytes, part_bytes):
    monkeypatch.setattr(tokens, "COLUMN_BYTES", column_bytes)
    monkeypatch.setattr(tokens, "PART_BYTES", part_bytes)
    texts = [t for _, t, *_ in rows()] + ["it\x01s \x01 a.\x01", "x <|ENDOFTEXT|> Y.", "ABC.!, Don't 12.5 É.", " ... . ."]
    encoder = tokens.RunEncoder(PATH)
    for column in (pa.array(texts), pa.array(["before", *texts], pa.large_string())[1:], pa.array([], pa.string())):
        found = list(encoder.encode_column(column))
        assert [i for part, _ in found for i in range(part.start, part.stop)] == list(range(len(column)))
        assert [ids.tolist() for _, each in found for ids in each] == [encoded(library, t.as_py()) for t in column]


def test_columns_are_encoded_once_a_run_and_not_held():
    rng = random.Random(7)
    words = list({"".join(rng.choice("aeioustrnl") for _ in range(9)) for _ in range(3000)})
    texts = [" ".join(rng.choice(words) + rng.choice(["", ".", ","]) for _ in range(50)) for _ in range(2000)]
    encoder = tokens.RunEncoder(PATH)
    encoder.model, encoder.tokenizer = Counted(encoder.model), Counted(encoder.tokenizer)
    assert sum(len(each) for _, each in encoder.encode_column(pa.array(texts))) == len(texts)
    assert sum(encoder.model.sizes) + sum(encoder.tokenizer.sizes) < 2 * sum(map(len, words))
    assert not encoder.slots


def test_points_that_are_part_of_other_tokens(library):
    texts = ["ab's ab' 's ab'. ab-cd ab--cd ab). (ab) \"ab\" ab;: ab|> ab<|endoftext|>. ab!<|endoftext|> .,ab a.b, ...", "é.é! ÿ?? \u0301. ab\u0301."]
    encoder = tokens.RunEncoder(PATH)
    assert [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])] == [encoded(library, t) for t in texts]


def test_a_tokenizer_that_keeps_white_space_is_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        tokens.RunEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def same_as_library(library, doc_rows, found):
    by_id = defaultdict(list)
    for r in found:
        by_id[r.doc_id].append(r)
    assert sum(map(len, by_id.values())) == len(doc_rows)
    for doc_id, text, *_ in doc_rows:
        ids = encoded(library, text)
        decoded = library.decode(ids, skip_special_tokens=False)
        for r in by_id[doc_id]:
            assert r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


@pytest.mark.parametrize(("chunk", "bits"), [(256, 1 << 24), (16, 1 << 24), (3, 1 << 24), (64, 64), (1024, 1 << 24), (100, 1 << 24)])
def test_chunks_give_the_ids_of_whole_texts(spark, library, chunk, bits):
    docs = spark.createDataFrame(rows() + rows()[:3], DDL)
    found = chunked_bpe.encode_documents(docs, PATH, chunk=chunk, filter_bits=bits)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert len(found.collect()) == len(rows()) + 3
    same_as_library(library, rows(), chunked_bpe.encode_documents(spark.createDataFrame(rows(), DDL), PATH, chunk=chunk, filter_bits=bits).collect())


def test_joins_are_repaired(library):
    rng = random.Random(8)
    for text in (t for _, t, *_ in rows() if t and len(t) < 3000):
        raw = text.encode()
        places = [i for i in range(1, len(raw)) if raw[i] & 0xC0 != 0x80]
        for count in (1, 4, len(places) // 2):
            ends = sorted(rng.sample(places, min(count, len(places)))) + [len(raw)]
            chunks = []
            for a, b in zip([0, *ends], ends):
                runs = raw[a:b].split()
                own = [encoded(library, r.decode()) for r in runs]
                flat = np.array([i for x in own for i in x], np.uint32)
                chunks.append((b - a, flat, np.array([len(x) for x in own], np.int64)))
            assert chunked_bpe.joined(raw, chunks, library).tolist() == encoded(library, text)


def test_windows_of_many_texts_are_encoded_together(library):
    encoder, calls = tokens.RunEncoder(PATH), []

    def encode(windows):
        calls.append(windows)
        return encoder.encode(windows)

    texts, segments = [t.encode() for _, t, *_ in rows() if t and 20 < len(t) < 3000], []
    for raw in texts:
        ends = [i for i in range(9, len(raw), 9) if raw[i] & 0xC0 != 0x80] + [len(raw)]
        split = [encoder.runs_of(raw[a:b]) for a, b in zip([0, *ends], ends)]
        sizes = np.diff([0, *ends]).tolist()
        segments.append([(size, *part) for size, part in zip(sizes, encoder.with_runs(split))])
    found = list(chunked_bpe.joined_all(list(zip(texts, segments)), encode))
    assert [ids.tolist() for ids in found] == [encoded(library, raw.decode()) for raw in texts]
    assert len(calls[0]) > 1000
    assert all(len(windows) == 1 for windows in calls[1:])
    assert len(calls) < len(calls[0]) / 20


def test_shared_chunks_are_cut_in_the_first_pass_only(spark, capsys):
    docs = spark.createDataFrame(rows(), DDL)
    chunked_bpe.encode_documents(docs, PATH).explain()
    plan = capsys.readouterr().out
    assert plan.count("MapInArrow") == 3  # pieces, their ids, the texts


def test_cuts_do_not_see_where_hashing_is_split():
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 3 * chunked_bpe.BLOCK, np.uint8))
    texts = [passage, b"x" * 777 + passage, passage[5:]]
    first, second, third = chunked_bpe.cuts(texts, 64)
    assert len(first) > 1000
    assert [e for e in second if e > 800] == [e + 777 for e in first if e > 23]
    assert [e + 5 for e in third if e > 40] == [e for e in first if e > 45]
    assert [chunked_bpe.cuts([text], 64)[0] for text in texts] == [first, second, third]


def test_cuts_follow_the_content():
    rng = np.random.default_rng(2)
    passage = bytes(rng.integers(97, 123, 4000, np.uint8))
    first, second = chunked_bpe.cuts([b"front " + passage, passage + b" tail"], 64)
    assert len(first) > 20
    inside = {e - 6 for e in first if 30 < e - 6 < 4000}
    assert inside == {e for e in second if 30 < e < 4000}


def test_whole_results_round_trip(spark, library):
    docs = spark.createDataFrame(rows(), DDL)
    for r in chunked_bpe.encode_documents(docs, PATH, whole=True).collect():
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
        assert r.n_tokens == len(r.ids)


def test_bpe_of_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    same_as_library(library, [tuple(r) for r in docs.select("doc_id", "text").collect()], chunked_bpe.digest(docs).collect())


def check_pieces(library, doc_rows, pieces, length, end_id=1):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc_id, text, *_ in doc_rows:
        ids = [*encoded(library, text), end_id]
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            piece = np.array(ids[at : at + p.length], "<u4")
            assert p.length == len(piece) > 0
            assert p.ids_crc32 == zlib.crc32(piece.tobytes())
            at += p.length
        assert at == len(ids)
    last = max(by_sequence)
    assert set(by_sequence) == set(range(last + 1))
    for number, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length if number < last else 0 < at <= length


@pytest.mark.parametrize("targets", [None, {"hot": 0.2, "a": 0.4}])
def test_pieces(spark, library, targets):
    docs = spark.createDataFrame(rows(), DDL)
    pieces = packing.pack(docs, PATH, length=128, window_sequences=4, targets=targets, with_ids=True).collect()
    check_pieces(library, rows(), pieces, 128)
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)


def played(sizes, targets, window):
    """Tokens of each queue in each window, as fractions: queues send their shares of a window, in turn until one ends."""
    left = {q: Fraction(n) for q, n in sizes.items()}
    wanted = {q: Fraction(share) for q, share in (targets or {}).items() if q in sizes}
    others = [q for q in sizes if q not in wanted]
    rest, total = sum(sizes[q] for q in others), sum(wanted.values())
    spare = max(Fraction(0), 1 - total) if others else Fraction(0)
    share = wanted | {q: spare * sizes[q] / rest for q in others}
    windows, room = [dict.fromkeys(sizes, Fraction(0))], Fraction(window)
    while any(left.values()):
        active = {q: share[q] for q in sizes if left[q] and share[q]}
        if not active:
            active = {q: Fraction(sizes[q]) for q in sizes if left[q]}
        whole = sum(active.values())
        step = min([room, *(left[q] * whole / s for q, s in active.items())])
        for q, s in active.items():
            windows[-1][q] += step * s / whole
            left[q] -= step * s / whole
        room -= step
        if not room and any(left.values()):
            windows.append(dict.fromkeys(sizes, Fraction(0)))
            room = Fraction(window)
    return windows


def random_sizes(seed, lengths, weights="aaabbc"):
    rng = random.Random(seed)
    return [(i, rng.choice(weights), rng.choice(lengths)) for i in range(300)]


CASES = [
    (None, [1, 5, 40, 300]),
    ({"a": 0.5, "b": 0.25, "c": 0.25}, [1, 5, 40, 300]),
    ({"a": 0.5, "b": 0.25, "c": 0.25}, [3, 9000]),  # documents of many windows
    ({"c": 0.5}, [1, 5, 40]),  # others share the rest; this one ends early
    ({"a": 0.0, "b": 0.5, "c": 0.5}, [7, 100]),  # comes last
    ({"a": 0.0}, [7, 100]),
    ({"a": 0.0, "b": 0.0, "c": 0.0}, [7, 100]),
    ({"a": 3.0, "b": 1.0}, [7, 100]),  # nothing is left for others
    ({"a": 0.2, "b": 0.1, "c": 0.1, "absent": 0.6}, [7, 100]),
    ({"b": 1 / 3, "c": 1e-9}, [1, 2, 500]),
]


@pytest.mark.parametrize("targets, lengths", CASES)
def test_windows_are_those_that_are_played(spark, targets, lengths):
    sizes, window = random_sizes(str(targets), lengths), 512
    frame = spark.createDataFrame([(i, f"of {q}", n) for i, q, n in sizes], "row long, queue string, tokens long")
    pieces = packing.in_rounds(frame, window, targets)
    found = pieces.collect()
    totals = defaultdict(int)
    for _, q, n in sizes:
        totals[q] += n
    shares = {q: s for q, s in (targets or {}).items()}
    if targets and set(totals) <= set(targets) and sum(s for q, s in shares.items() if q in totals):
        shares = {q: s / sum(s for q, s in shares.items() if q in totals) for q, s in shares.items()}
    expected = played(totals, shares, window)
    sent = defaultdict(lambda: defaultdict(int))
    for r in found:
        sent[r["round"]][r.queue[3:]] += r.length
    assert set(sent) == set(range(len(expected)))
    for q in totals:  # never further than a token from what the queue should have sent so far
        ahead = 0
        for number, window_of in enumerate(expected):
            ahead += sent[number][q] - window_of[q]
            assert abs(ahead) <= 1 + 1e-6, (q, number)
    for row, q, n in sizes:  # every document whole, in order
        own = sorted((r["round"], r.start, r.length) for r in found if r.row == row)
        assert [start for _, start, _ in own] == [sum(x[2] for x in own[:i]) for i in range(len(own))]
        assert sum(x[2] for x in own) == n
    begins = sorted((p.begin, p.length) for r in packing.in_stream(pieces).collect() for p in r.pieces)
    assert [b for b, _ in begins] == [sum(n for _, n in begins[:i]) for i in range(len(begins))]


@pytest.mark.parametrize("targets", [{"a": -0.1}, {"a": float("nan")}, {"a": float("inf")}])
def test_targets_that_are_no_shares(spark, targets):
    with pytest.raises(ValueError, match="targets"):
        packing.mixture({"of a": 5}, 10, targets)


@pytest.mark.parametrize("targets", [None, {"hot": 0.5, "long": 0.3, "rare": 0.2}])
def test_windows_keep_the_mixture(spark, targets):
    """Also with documents longer than a window, until a queue ends."""
    docs = [(i, "word " * 20, "hot" if i % 3 else "rare") for i in range(3000)]
    docs += [(10_000 + i, "word " * 9_000, "long") for i in range(3)]
    pieces = packing.pack(
        spark.createDataFrame(docs, "doc_id long, text string, source string"), PATH,
        length=64, window_sequences=64, targets=targets,
    ).collect()
    windows, source = defaultdict(lambda: defaultdict(int)), {i: s for i, _, s in docs}
    for p in pieces:
        assert p.window_id == p.sequence_id // 64
        windows[p.window_id][source[p.doc_id]] += p.length
    totals = {s: sum(w[s] for w in windows.values()) for s in ("hot", "long", "rare")}
    shares = targets or {s: n / sum(totals.values()) for s, n in totals.items()}
    end = min(totals[s] / shares[s] for s in shares) // 4096
    assert end > 5
    for number in range(int(end)):
        assert sum(windows[number].values()) == 4096
        assert all(abs(windows[number][s] - shares[s] * 4096) <= 4 for s in shares)


def test_windows_of_the_whole_table_have_its_proportions(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    pieces = packing.digest(docs).join(docs.select("doc_id", "source"), "doc_id")
    sizes = {(r.window_id, r.source): r.n for r in pieces.groupBy("window_id", "source").agg({"length": "sum"}).withColumnRenamed("sum(length)", "n").collect()}
    last = max(w for w, _ in sizes)
    sources = {s for _, s in sizes}
    total = sum(sizes.values())
    assert last > 5
    for source in sources:
        share = sum(n for (_, s), n in sizes.items() if s == source) / total
        for window in range(last):
            assert abs(sizes.get((window, source), 0) - share * 64 * 2048) <= len(sources) + 1


def test_packing_of_the_whole_table(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    check_pieces(library, [tuple(r) for r in docs.select("doc_id", "text").collect()], packing.digest(docs).collect(), 2048)


def test_empty_tables_and_repeated_rows(spark):
    empty = spark.createDataFrame([], DDL)
    assert packing.pack(empty, PATH).count() == 0
    assert chunked_bpe.encode_documents(empty, PATH).count() == 0
    twice = spark.createDataFrame([(1, "a b", None), (1, "a b", None), (None, None, "s")], "doc_id long, text string, source string")
    assert packing.pack(twice, PATH).agg({"length": "sum"}).first()[0] == 7
