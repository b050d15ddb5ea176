"""The streaming Viterbi search against the full search, and exact round trips."""

from __future__ import annotations

import random
import time

import pandas as pd
import pytest

from millrace.llm import queries
from millrace.llm.sentencepiece_codec import BLANK, Codec, Encoder, Vocabulary, decoded, encoded
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary.load(queries.SENTENCEPIECE_MODEL)


def full_search(v, text):
    """Best score over the whole text, with every position kept."""
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        best[i + 1] = max(best[i + 1], best[i] + v.unknown_score)
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            if text[i:j] in v.scores:
                best[j] = max(best[j], best[i] + v.scores[text[i:j]][0])
    return best[-1]


def score_of(v, ids):
    points = {i: s for s, i in v.scores.values()}
    wide = {b: 0 for b in v.byte_ids}
    return sum(points.get(i, wide.get(i, 0)) for i in ids)


def small_vocabulary(rng, splits=True):
    """Few letters and many pieces, so that paths stay apart for long."""
    pieces = {"a", "b", BLANK}
    while len(pieces) < 25:
        p = "".join(rng.choice("ab") for _ in range(rng.randint(1, 5)))
        pieces.add(BLANK + p if splits and rng.random() < 0.4 else p)
    if not splits:
        pieces.add("a" + BLANK + "b")
    pieces = sorted(pieces)
    return Vocabulary.of({p: (-rng.random() * 10, 256 + i) for i, p in enumerate(pieces)}, list(range(256)),
                         [bytes([b]) for b in range(256)] + [p.replace(BLANK, " ").encode() for p in pieces])


@pytest.mark.parametrize("splits", [True, False])
def test_search_is_optimal(splits):
    rng = random.Random(4)
    for _ in range(6):
        v = small_vocabulary(rng, splits)
        codec, encoder = Codec(v), Encoder(v)
        for _ in range(5):
            text = "".join(rng.choice("aabb ") for _ in range(rng.randint(1, 300)))
            marked = BLANK + text.replace(" ", BLANK)
            cut = rng.randint(0, len(marked))
            streamed = encoder.feed(marked[:cut]) + encoder.feed(marked[cut:]) + encoder.finish()
            ids = codec.encode(text)
            for got in (streamed, ids):
                assert abs(score_of(v, got) - full_search(v, marked)) < 1e-6
                assert codec.decode(got) == text


def test_window_stays_small():
    v = small_vocabulary(random.Random(9))
    encoder, most = Encoder(v), 0
    for _ in range(300):
        encoder.feed("abba" * 8)
        most = max(most, len(encoder.best))
    assert most < 400


def test_long_stretches(vocabulary):
    """Without a blank, the window stays bounded and time grows with the length only."""
    rng, codec = random.Random(14), Codec(vocabulary)
    for text in ("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(100_000)), "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))):
        began = time.perf_counter()
        ids = codec.encode(text)
        assert time.perf_counter() - began < 10
        assert codec.decode(ids) == text
        assert codec.encode(text[:3000]) == whole(vocabulary, BLANK + text[:3000])
        widest, encoder = 0, Encoder(vocabulary)
        for at in range(0, len(text), 1000):
            encoder.feed(text[at:at + 1000])
            widest = max(widest, len(encoder.best))
        assert widest < 1000 + 20 * vocabulary.longest


def whole(v, text):
    """The ids of the best path, with every position kept; of equal sums the first found stays."""
    best, back = [0.0] + [float("-inf")] * len(text), [None] * (len(text) + 1)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + v.longest) + 1):
            options = [(v.unknown_score, None)] if j == i + 1 else []
            if text[i:j] in v.scores:
                options.append(v.scores[text[i:j]])
            for score, piece in options:
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, piece)
    steps, at = [], len(text)
    while at:
        start, piece = back[at]
        steps.append([piece] if piece is not None else [v.byte_ids[b] for b in text[start:at].encode()])
        at = start
    return [i for s in reversed(steps) for i in s]


def test_paths_that_never_meet():
    """Only pairs are pieces: odd and even boundaries stay apart to the end."""
    v = Vocabulary.of({"aa": (-1.0, 256)}, list(range(256)), [bytes([b]) for b in range(256)] + [b"aa"])
    began = time.perf_counter()
    encoder = Encoder(v)
    ids = encoder.feed("a" * 200_001) + encoder.finish()
    assert time.perf_counter() - began < 10 and ids.count(256) == 100_000 and ids.count(97) == 1


def test_library_agrees(vocabulary):
    """The library's unigram search keeps sums in floats: compare texts without unknown characters."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    from sentencepiece import SentencePieceProcessor

    model = pb.ModelProto()
    with open(queries.SENTENCEPIECE_MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    library, codec = SentencePieceProcessor(model_proto=model.SerializeToString()), Codec(vocabulary)
    for text in pd.read_parquet(f"{SMALL}/documents.parquet")["text"]:
        for line in text.split("\n")[:5]:
            if line and max(map(ord, line)) < 0x250 and line.isprintable():
                assert score_of(vocabulary, codec.encode(line)) >= score_of(vocabulary, library.encode(line)) - 1e-3 * len(line)


def test_query_round_trip(spark):
    rows = queries.op9_sentencepiece(spark, SMALL).collect()
    assert len(rows) == 200 and all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in rows)


def test_edges(rows_of, vocabulary):
    texts = [None, "", " ", "   x ", "▁", "a▁ ▁▁b", "\x00\n\r", "日本語😀", "x" * 50_000, "lange wörter " * 20_000, "é"]
    docs = rows_of([(i, t, i, "q", [1]) for i, t in enumerate(texts)] + [(None, "a", 1, "q", None)], "doc_id long, text string, at int, decoded string, ids array<int>")
    back = {r["doc_id"]: r["decoded"] for r in decoded(encoded(docs, vocabulary), vocabulary).collect()}
    assert back == {**{i: t or "" for i, t in enumerate(texts)}, None: "a"}
    empty = decoded(encoded(rows_of([], "doc_id long, text string"), vocabulary), vocabulary)
    assert empty.collect() == [] and empty.columns == ["doc_id", "text", "ids", "decoded"]
