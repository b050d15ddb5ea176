"""Text to SentencePiece ids and back, by a streaming Viterbi search.

The best segmentation is the one with the largest sum of piece scores, as the
unigram model defines it, over the pieces and scores of the vocabulary file. Open
paths end within the longest piece of the position reached; ids are committed as
soon as all backpointer paths meet in one boundary. A word of up to 32 characters
is searched with others side by side; longer stretches are fed in portions, and the
window holds one portion and what no meeting has settled yet. Time is linear in the
length. A space becomes U+2581, a dummy one goes in front,
and a character that no piece covers falls back to its UTF-8 bytes. U+2581 itself
in a text goes to bytes too, which makes decoding exact.

Among equal sums the segmentation whose last piece is the longest wins.

Cases: null and empty texts give no ids and decode to ""; repeated rows are coded
alike; an empty table gives an empty result. ``ids`` and ``decoded`` of the input
are replaced; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

BLANK = "▁"
_CHECK_EVERY = 64
_FED = 4096
_NONE = float("-inf")
_AT_ONCE = 4_000_000


@dataclass
class Vocabulary:
    pieces: list[bytes]
    scores: dict[str, tuple[float, int]]
    byte_ids: list[int]
    unknown_score: float
    longest: int = 0
    splits: bool = True
    table: dict[str, tuple[float, int]] = field(default_factory=dict)  # pieces, and their beginnings with id -1

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        scores, byte_ids, pieces = {}, [0] * 256, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                pieces.append(bytes([int(piece[3:5], 16)]))
            elif model.is_unknown(i) or model.is_control(i) or model.is_unused(i):
                pieces.append(b"")
            else:
                scores[piece] = (model.get_score(i), i)
                pieces.append(piece.replace(BLANK, " ").encode())
        return cls.of(scores, byte_ids, pieces)

    @classmethod
    def of(cls, scores: dict, byte_ids: list[int], pieces: list[bytes]) -> "Vocabulary":
        table = {p[:k]: (0.0, -1) for p in scores for k in range(1, len(p))} | scores
        # A blank inside a piece would let pieces cross from word to word.
        splits = not any(BLANK in p.lstrip(BLANK) for p in scores)
        lowest = min((s for s, _ in scores.values()), default=0.0)
        return cls(pieces, scores, byte_ids, lowest - 10, max(map(len, scores), default=1), splits, table)


class Encoder:
    """``feed`` takes text with blanks replaced and returns the ids that are settled; ``finish`` the rest.

    Positions count from the start of ``text``; those before ``start`` are committed
    and leave the window at the next ``feed``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._reset()

    def _reset(self) -> None:
        self.text = ""
        self.start = 0                 # the last committed boundary
        self.best = [0.0]              # best sum from that boundary to each position
        self.back = [(0, None)]        # where the best last piece starts, and its id (None: bytes)
        self.done = 0                  # positions whose pieces have been tried
        self.ends = 0                  # the farthest end of a tried piece
        self.check = _CHECK_EVERY      # where to look for a meeting next

    def _forget(self) -> None:
        cut, self.start = self.start, 0
        self.text, self.best = self.text[cut:], self.best[cut:]
        self.back = [(s - cut, p) for s, p in self.back[cut:]]
        self.done, self.ends, self.check = self.done - cut, self.ends - cut, self.check - cut

    def feed(self, text: str, last: bool = False) -> list[int]:
        if self.start:
            self._forget()
        text = self.text = self.text + text
        v, table, best, back = self.v, self.v.table, self.best, self.back
        unknown, longest = v.unknown_score, v.longest
        ids: list[int] = []
        known = len(text)
        best += [_NONE] * (known + 1 - len(best))
        back += [(0, None)] * (known + 1 - len(back))
        usable = known if last else known - longest + 1
        done, ends, check = self.done, self.ends, self.check
        while done < usable:
            base = best[done]
            j = done + 1
            if base + unknown > best[j]:
                best[j], back[j] = base + unknown, (done, None)
            if j > ends:
                ends = j
            while j <= known:
                hit = table.get(text[done:j])
                if hit is None:
                    break              # no piece begins like this
                score, piece = hit
                if piece >= 0:
                    if base + score > best[j]:
                        best[j], back[j] = base + score, (done, piece)
                    if j > ends:
                        ends = j
                j += 1
            done += 1
            if ends > done and done < check:
                continue
            self.done, self.ends = done, ends
            # Where nothing reaches past here there is one survivor.
            cut = done if ends == done else self._meeting()
            if cut > self.start:
                ids += self._commit(cut)
                check = done + _CHECK_EVERY
            else:
                # Paths that stay apart are walked again only when they have doubled.
                check = done + max(_CHECK_EVERY, done - self.start)
        self.done, self.ends, self.check = done, ends, check
        return ids

    def _meeting(self) -> int:
        """The last boundary that the paths of all open positions share."""
        open_ends = {p for p in range(self.done, self.ends + 1) if self.best[p] > _NONE}
        while len(open_ends) > 1:
            farthest = max(open_ends)
            open_ends.remove(farthest)
            open_ends.add(self.back[farthest][0])
        return open_ends.pop()

    def _commit(self, cut: int) -> list[int]:
        steps, at = [], cut
        while at > self.start:
            start, piece = self.back[at]
            steps.append([piece] if piece is not None else [self.v.byte_ids[b] for b in self.text[start:at].encode("utf-8", "surrogatepass")])
            at = start
        base = self.best[cut]
        for p in range(cut, self.ends + 1):
            self.best[p] -= base
        self.start = cut
        return list(chain.from_iterable(reversed(steps)))

    def finish(self) -> list[int]:
        ids = self.feed("", last=True)
        if len(self.text) > self.start:
            ids += self._commit(len(self.text))
        self._reset()
        return ids


_GROUPS = (6, 8, 10, 12, 16, 24, 32)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 17


class WordSearch:
    """The same search for many short words side by side: one step takes a character of every word.

    A step needs the scores of the last ``longest`` positions only, and at a
    word's end all paths meet. Pieces are found by a 64-bit rolling hash; the
    caller compares the decoded result with the words.
    """

    def __init__(self, v: Vocabulary):
        self.v = v
        with np.errstate(over="ignore"):
            hashes = np.array([self._hash(p) for p in v.scores], np.uint64)
            slots = 1 << max(_SLOT_BITS, (4 * len(hashes)).bit_length())
            self.shift = np.uint64(64 - (slots.bit_length() - 1))
            self.keys, self.where = np.zeros(slots, np.uint64), np.full(slots, -1, np.int64)
            self.ids = np.array([i for _, i in v.scores.values()], np.int64)
            self.points = np.array([s for s, _ in v.scores.values()], np.float64)
            self.probes = 1
            for n, h in enumerate(hashes):
                at, tries = int((h * _STEP) >> self.shift), 1
                while self.where[at] >= 0:
                    at, tries = (at + 1) % slots, tries + 1
                self.keys[at], self.where[at] = h, n
                self.probes = max(self.probes, tries)
            self.powers = np.ones(v.longest + 1, np.uint64)
            for k in range(1, v.longest + 1):
                self.powers[k] = self.powers[k - 1] * _STEP
        self.by_byte = np.array([v.byte_ids[b] if b < 128 else -1 for b in range(256)], np.int64)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_STEP) + ord(c) + 1) % 2**64
        return h

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        at = ((hashes * _STEP) >> self.shift).astype(np.int64)
        found = np.where(self.keys[at] == hashes, self.where[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.where[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) % len(self.keys)
            same = self.keys[at[open_]] == hashes[open_]
            found[open_[same]] = self.where[at[open_[same]]]
            open_ = open_[~same & (self.where[at[open_]] >= 0)]
        return found

    def best(self, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids word after word, how many each, and which words need the byte fallback for a wide character."""
        many, width = chars.shape
        v = self.v
        with np.errstate(over="ignore"):
            prefix = np.zeros((width + 1, many), np.uint64)
            for i in range(width):
                prefix[i + 1] = prefix[i] * _STEP + chars[:, i].astype(np.uint64) + np.uint64(1)
            score = np.full((width + 1, many), _NONE)
            score[0] = 0
            back, piece = np.zeros((width + 1, many), np.int8), np.full((width + 1, many), -1, np.int64)
            for i in range(1, width + 1):
                for size in range(min(i, v.longest), 0, -1):
                    found = self._lookup(prefix[i] - prefix[i - size] * self.powers[size])
                    hit = np.flatnonzero(found >= 0)
                    total = score[i - size, hit] + self.points[found[hit]]
                    better = total > score[i, hit]
                    hit, total = hit[better], total[better]
                    score[i, hit], back[i, hit], piece[i, hit] = total, size, self.ids[found[hit]]
                plain = score[i - 1] + v.unknown_score
                worse = np.flatnonzero(plain > score[i])
                code = chars[worse, i - 1]
                score[i, worse], back[i, worse] = plain[worse], 1
                piece[i, worse] = np.where(code < 128, self.by_byte[np.minimum(code, 255)], -1)
        at, taken, wide = sizes.astype(np.int64).copy(), [], np.zeros(many, bool)
        every = np.arange(many)
        while at.any():
            now = np.where(at > 0, piece[at, every], -2)
            wide |= now == -1
            taken.append(now)
            at = at - np.where(at > 0, back[at, every], 0)
        steps = np.array(taken[::-1]).T if taken else np.zeros((many, 0), np.int64)
        used = steps != -2
        return steps[used], used.sum(axis=1), wide


class Codec:
    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.encoder = Encoder(vocabulary)
        self.search = WordSearch(vocabulary)
        # A stretch at whose ends all paths meet: no piece has a blank behind a letter.
        self.words = re.compile(f"{BLANK}+[^{BLANK}]*" if vocabulary.splits else "(?s).+")
        self.literal = [vocabulary.byte_ids[b] for b in BLANK.encode()]

    def _parts(self, text: str | None) -> list[str]:
        """Stretches coded on their own; an empty one stands for a U+2581 of the text."""
        if not text:
            return []
        first, *others = text.split(BLANK)
        parts = self.words.findall(BLANK + first.replace(" ", BLANK))
        for more in others:
            parts.append("")
            more = more.replace(" ", BLANK)
            cut = more.find(BLANK) if self.v.splits else -1
            if cut < 0:
                parts += [more] if more else []
            else:
                parts += [more[:cut]] * bool(cut) + self.words.findall(more[cut:])
        return parts

    def _stream(self, part: str) -> list[int]:
        if not part:
            return self.literal
        ids = []
        for at in range(0, len(part), _FED):
            ids += self.encoder.feed(part[at:at + _FED])
        return ids + self.encoder.finish()

    def _distinct(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word, one after the other, and where each begins."""
        sizes = np.array([len(w) for w in words], np.int64)
        coded: list = [None] * len(words)
        low = 0
        for top in _GROUPS:
            group = np.flatnonzero((sizes > low) & (sizes <= top))
            low = top
            if not len(group):
                continue
            own = [words[g] for g in group]
            flat = np.frombuffer("".join(own).encode("utf-32-le", "surrogatepass"), np.uint32)
            column = np.arange(top) < sizes[group][:, None]
            chars = np.zeros((len(group), top), np.int64)
            chars[column] = flat
            ids, counts, wide = self.search.best(chars, sizes[group])
            read = b"".join(map(self.v.pieces.__getitem__, ids)) if not wide.any() else b""
            right = not wide.any() and read == "".join(own).replace(BLANK, " ").encode("utf-8", "surrogatepass")
            for g, w, part, bad in zip(group, own, np.split(ids, np.cumsum(counts)[:-1]), wide, strict=True):
                if right:
                    coded[g] = part
                elif not bad and b"".join(map(self.v.pieces.__getitem__, part)) == w.replace(BLANK, " ").encode("utf-8", "surrogatepass"):
                    coded[g] = part
                else:
                    coded[g] = self._stream(w)
        for g in np.flatnonzero((sizes == 0) | (sizes > low)):
            coded[g] = self._stream(words[g])
        starts = np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
        return np.concatenate([np.zeros(0, np.int64), *coded]), starts

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text begins."""
        index: dict[str, int] = {}
        place, parts_of = [], []
        for text in texts:
            parts = self._parts(text)
            parts_of.append(len(parts))
            place += [index.setdefault(p, len(index)) for p in parts]
        ids, starts = self._distinct(list(index))
        at = np.array(place, np.int64)
        counts = (starts[1:] - starts[:-1])[at]
        ends = np.cumsum(counts)
        values = ids[np.repeat(starts[at] - (ends - counts), counts) + np.arange(counts.sum())]
        ends = np.concatenate([[0], ends])
        return values.astype(np.int32), ends[np.concatenate([[0], np.cumsum(parts_of)]).astype(np.int64)]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def decode(self, ids) -> str:
        raw = b"".join(map(self.v.pieces.__getitem__, ids)).decode("utf-8", "replace")
        return raw[1:] if raw.startswith(" ") else raw


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes or ids in all."""
    group = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _replaced(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n.lower() != name]
    return pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), column], [*names, name])


def _schema(df: DataFrame, name: str, kind: str):
    from pyspark.sql.types import _parse_datatype_string, StructType

    kept = [f for f in df.schema.fields if f.name.lower() != name]
    return StructType([*kept, *_parse_datatype_string(f"{name} {kind}").fields])


def encoded(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``docs`` and ``ids``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # one vocabulary file

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for whole in batches:
            sizes = np.array(pc.binary_length(whole.column("text")).fill_null(0), np.int64)
            for batch in _slices(whole, sizes, _AT_ONCE):
                values, offsets = codec.encode_all(batch.column("text").to_pylist())
                yield _replaced(batch, "ids", pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values)))

    source = docs.withColumn("text", F.col("text").cast("string"))
    return source.mapInArrow(each, _schema(source, "ids", "array<int>"))


def decoded(coded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The columns of ``coded`` and ``decoded``, the text that ``ids`` stand for."""
    shared = coded.sparkSession.sparkContext.broadcast(vocabulary)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for whole in batches:
            sizes = np.array(pc.list_value_length(whole.column("ids")).fill_null(0), np.int64)
            for batch in _slices(whole, sizes, _AT_ONCE // 4):
                texts = [codec.decode(ids or []) for ids in batch.column("ids").to_pylist()]
                yield _replaced(batch, "decoded", pa.array(texts, pa.string()))

    return coded.mapInArrow(each, _schema(coded, "decoded", "string"))
