"""SentencePiece-style encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads the bytes of a text; at each position the chain of output links gives every piece that ends there, and
each relaxes the best score of that position from the score before the piece. Blanks are written as the marker U+2581. When
no piece has a marker behind another character, best paths of a text are the best paths of its words (a run of
markers and what follows up to the next marker), so each distinct word is solved once; many words are solved in lockstep, one
numpy step for a byte of all. With other vocabularies the whole text is one word.

A unigram vocabulary scores by its own log-probabilities. A byte-pair vocabulary has merge ranks as scores, which are not
log-probabilities; there the score of a piece is -log(2 + rank), as by Zipf's law. So ids can differ from those of the
library's merging, but decoding gives the text back exactly.
"""

from __future__ import annotations

import struct
import uuid
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from quire.llm.automaton import ByteAutomaton
from quire.llm.common import in_batches, with_texts

MARKER = "▁"
CACHE_WORDS = 250_000
BATCH_CHARS = 1_000_000
LOCKSTEP_CELLS = 1 << 20
LONG_WORD = 4096
LONGEST_KEPT = 64
# The kinds of pieces and of models in the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    model: int = UNIGRAM
    dummy_prefix: bool = True


def read_vocabulary(data: bytes) -> Vocabulary:
    """The pieces of a model file, by the wire format of protocol buffers: field 1 holds a piece (1 text, 2 score, 3 kind), field 2
    the trainer's settings (3 kind of model), field 3 the normaliser's (3 whether a blank is put first). A file that maps characters (2), drops
    blanks (4) or does not escape them (5) is refused."""
    found = Vocabulary([], [], [])
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            found.pieces.append(piece[1].decode())
            found.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            found.kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            found.model = dict(_fields(value)).get(3, UNIGRAM)
        elif number == 3:
            settings = dict(_fields(value))
            if settings.get(2) or settings.get(4, 1) or not settings.get(5, 1):
                raise ValueError("not supported in a model file: a normaliser that changes texts")
            found.dummy_prefix = bool(settings.get(3, 1))
    return found


def _fields(data: bytes):
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {5: 4, 1: 8}[kind]
            yield key >> 3, data[at : at + size]
            at += size


class Codec:
    """Encodes and decodes by one vocabulary; it must have all 256 byte pieces, which cover what no other piece does."""

    def __init__(self, vocabulary: Vocabulary):
        self.dummy_prefix = vocabulary.dummy_prefix
        usable = [i for i, k in enumerate(vocabulary.kinds) if k in (NORMAL, USER_DEFINED) and vocabulary.pieces[i]]
        of_byte = {int(vocabulary.pieces[i][3:5], 16): i for i, k in enumerate(vocabulary.kinds) if k == BYTE}
        if len(of_byte) < 256:
            raise ValueError("the vocabulary lacks byte pieces")
        keys = [vocabulary.pieces[i].encode() for i in usable]
        ranked = vocabulary.model == BPE
        score = lambda i: -np.log(2.0 - max(vocabulary.scores[i], -1e6)) if ranked else vocabulary.scores[i]
        self.ids = np.array(usable, np.int32)
        self.score = np.array([score(i) for i in usable], np.float64)
        self.size = np.array([len(k) for k in keys], np.int32)
        self.unknown = float(self.score.min(initial=0.0)) - 10.0
        self.byte_ids = np.array([of_byte[b] for b in range(256)], np.int32)
        self.automaton = ByteAutomaton(keys)
        self.by_word = not any(MARKER in vocabulary.pieces[i].lstrip(MARKER) for i in usable)
        self.text_of = [b""] * len(vocabulary.pieces)
        for i, key in zip(usable, keys):
            self.text_of[i] = key.replace(MARKER.encode(), b" ")
        for b, i in of_byte.items():
            self.text_of[i] = bytes([b])
        self.cache: dict[str, bytes] = {}  # a word's ids as 32-bit numbers

    # A marker in the text itself must not come back as a blank: it is spelled in bytes. Inside, two noncharacters stand for it:
    # U+10FFFF U+10FFFE; and for U+10FFFF itself stands U+10FFFF twice.
    _OWN, _SELF, _MARK = "\U0010ffff", "\U0010ffff\U0010ffff", "\U0010ffff\U0010fffe"

    def words(self, text: str) -> list[str]:
        """The words of a text, each with its markers in front."""
        if MARKER in text or self._OWN in text:
            text = text.replace(self._OWN, self._SELF).replace(MARKER, self._MARK)
        text = f" {text}" if self.dummy_prefix else text
        if not self.by_word:
            return [text.replace(" ", MARKER)]
        parts = text.split(" ")
        out = [parts[0]] if parts[0] else []
        blanks = 0
        for part in parts[1:]:
            blanks += 1
            if part:
                out.append(MARKER * blanks + part)
                blanks = 0
        if blanks:
            out.append(MARKER * blanks)
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; an empty text has none."""
        out: list[np.ndarray] = []
        cache = self.cache
        for batch in in_batches(texts, BATCH_CHARS):
            split = [self.words(t) if t else [] for t in batch]
            distinct = set(chain.from_iterable(split))
            missing = [w for w in distinct if w not in cache]
            if len(cache) + len(missing) > CACHE_WORDS:
                cache.clear()
                missing = list(distinct)
            cache.update(zip(missing, self.solve(missing)))
            out += [np.frombuffer(b"".join(map(cache.__getitem__, words)), np.int32) for words in split]
            for word in missing:
                if len(word) >= LONGEST_KEPT:
                    del cache[word]
        return out

    def solve(self, words: list[str]) -> list[bytes]:
        """Best paths, words of like length together."""
        raw = [w.encode() for w in words]
        sizes = list(map(len, raw))
        order = sorted(range(len(raw)), key=sizes.__getitem__)
        out = [b""] * len(raw)
        at = 0
        while at < len(order):
            if sizes[order[at]] > LONG_WORD:
                out[order[at]] = self._one(raw[order[at]])
                at += 1
                continue
            stop = at + 1
            while stop < len(order) and sizes[order[stop]] <= LONG_WORD and (stop + 1 - at) * sizes[order[stop]] <= LOCKSTEP_CELLS:
                stop += 1
            chosen = order[at:stop]
            for i, ids in zip(chosen, self._lockstep([raw[i] for i in chosen], sizes[chosen[-1]])):
                out[i] = ids
            at = stop
        if any(self._OWN in w for w in words):
            out = [self._restored(ids, r) for ids, r in zip(out, raw)]
        return out

    def _restored(self, packed: bytes, raw: bytes) -> bytes:
        """Byte spellings of the two stand-ins replaced by what they stand for."""
        if self._OWN.encode() not in raw:
            return packed
        ids = np.frombuffer(packed, np.int32).tolist()
        at = lambda s: [int(i) for i in self.byte_ids[list(s.encode())]]
        own, out, k = at(self._OWN), [], 0
        while k < len(ids):
            if ids[k : k + 4] == own:
                out += own if ids[k + 4 : k + 8] == own else at(MARKER)
                k += 8
            else:
                out.append(ids[k])
                k += 1
        return np.array(out, np.int32).tobytes()

    def _lockstep(self, raw: list[bytes], width: int) -> list[bytes]:
        n = len(raw)
        sizes = np.fromiter(map(len, raw), np.int64, n)
        grid = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in raw), np.uint8).reshape(n, width)
        machine = self.automaton
        best = np.full((width + 1, n), -np.inf)
        best[0] = 0.0
        back = np.full((width + 1, n), -1, np.int32)  # the piece that ends here, -1 for a byte
        node = np.zeros(n, np.int32)
        first = 0  # words are sorted by length: those before first have ended
        for k in range(width):
            while first < n and sizes[first] <= k:
                first += 1
            here = node[first:] = machine.go[node[first:], grid[first:, k]]
            best[k + 1, first:] = best[k, first:] + self.unknown
            out = machine.out[here]
            live = np.flatnonzero(out)
            while len(live):
                at = out[live]
                piece = machine.word[at]
                column = live + first
                value = best[k + 1 - self.size[piece], column] + self.score[piece]
                better = value > best[k + 1, column]
                best[k + 1, column[better]] = value[better]
                back[k + 1, column[better]] = piece[better]
                out[live] = machine.link[at]
                live = live[out[live] > 0]
        paths = np.zeros((n, width), np.int32)  # filled from the right
        place = sizes.copy()
        free = width
        starts = np.full(n, width)
        live = np.flatnonzero(place)
        while len(live):
            free -= 1
            piece = back[place[live], live]
            paths[live, free] = np.where(piece < 0, self.byte_ids[grid[live, place[live] - 1]], self.ids[piece])
            starts[live] = free
            place[live] -= np.where(piece < 0, 1, self.size[piece])
            live = live[place[live] > 0]
        packed, row = paths.tobytes(), 4 * width
        return [packed[k * row + 4 * a : (k + 1) * row] for k, a in enumerate(starts.tolist())]

    def _one(self, raw: bytes) -> bytes:
        """The same for one long word, without a cell for each byte of many words."""
        go, outs, link, word = self.automaton.go, self.automaton.out, self.automaton.link, self.automaton.word
        size, score = self.size.tolist(), self.score.tolist()
        best, back, node = [0.0], [-1], 0
        for k, byte in enumerate(raw):
            node = int(go[node, byte])
            top, via = best[k] + self.unknown, -1
            out = int(outs[node])
            while out:
                piece = int(word[out])
                value = best[k + 1 - size[piece]] + score[piece]
                if value > top:
                    top, via = value, piece
                out = int(link[out])
            best.append(top)
            back.append(via)
        ids, place = [], len(raw)
        while place:
            piece = back[place]
            ids.append(int(self.byte_ids[raw[place - 1]] if piece < 0 else self.ids[piece]))
            place -= 1 if piece < 0 else size[piece]
        return np.array(ids[::-1], np.int32).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD, and ids without a text are left out."""
        text = b"".join(map(self.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


_CODECS: dict[str, Codec] = {}


def _codec(own: str, shared) -> Codec:
    if own not in _CODECS:
        _CODECS.clear()
        _CODECS[own] = Codec(read_vocabulary(shared.value))
    return _CODECS[own]


def _shared(df: DataFrame, model_path: str):
    with open(model_path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read()), uuid.uuid4().hex


def encoded(df: DataFrame, model_path: str, text: str = "text") -> DataFrame:
    """df's columns but the text, with ids (array of int), n_pieces, and exact: whether decoding gave the text back.

    The whole text is encoded. A null or empty text has no ids and is exact. Ties go to the longer piece. Repeated rows stay;
    a column of df with the name of a result is replaced. The file is read on the driver and sent to the executors.
    """
    shared, own = _shared(df, model_path)

    def start():
        codec = _codec(own, shared)

        def apply(texts):
            texts = [t or "" for t in texts]
            ids = codec.encode(texts)
            return [ids, [len(x) for x in ids], [codec.decode(x) == t for x, t in zip(ids, texts)]]

        return apply

    return with_texts(df, text, "ids array<int>, n_pieces long, exact boolean", start)


def decoded(df: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """df's columns but the ids, with text. A null array or an empty one gives an empty text."""
    shared, own = _shared(df, model_path)

    def start():
        codec = _codec(own, shared)
        return lambda rows: [[codec.decode(np.array(x or [], np.int64)) for x in rows]]

    return with_texts(df, ids, "text string", start)
